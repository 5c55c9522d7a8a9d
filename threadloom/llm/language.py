"""The language of a text by a convolutional network over its bytes.

Filters of several widths run over windows of a fixed number of bytes; each
filter keeps its highest answer in the window, and a softmax over these answers
names the language.  The network is trained in numpy on labelled texts.  A text
is cut into windows that cover all of it; its answer is the mean of theirs,
weighted by their letters.

The training sample is bounded: ``PER_LANGUAGE`` texts for each language, each
with up to ``WINDOWS_PER_TEXT`` windows.  Prediction reads the text alone.

Before that, ASCII letters become lower case, as do the accented capitals of
Latin-1, and other ASCII characters blanks.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text if nothing labelled was given; equal texts get equal
answers; an empty table gives no rows; columns other than those named are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import bounded_batches, bounded_sample, byte_view, kept_by_worker, whole_text
from threadloom.llm.words import grouped

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
PER_LANGUAGE = 800
WINDOWS_PER_TEXT = 3
EPOCHS = 5
BATCH = 64
RATE = 0.02
CHUNK = 256


def plain_bytes(data):
    """Lower-case letters and blanks, byte by byte."""
    import numpy as np

    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for i in range(26):
        table[65 + i] = table[97 + i] = 97 + i
    plain = table[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        plain[1:][capital] += 0x20
    return plain


def windows_of(plain, starts, ends):
    """(windows, owner, letters): every byte of every text is in a window.

    The last window of a long text ends with the text; short texts are padded
    with blanks."""
    import numpy as np

    sizes = ends - starts
    counts = np.maximum(1, -(-sizes // WINDOW))
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = starts[owner] + np.maximum(0, np.minimum(nth * WINDOW, sizes[owner] - WINDOW))
    places = first[:, None] + np.arange(WINDOW)
    padded = np.concatenate([plain, np.full(WINDOW, 32, np.uint8)])
    windows = padded[np.minimum(places, len(padded) - 1)]
    windows[places >= ends[owner][:, None]] = 32
    return windows, owner, (windows != 32).sum(axis=1)


class ByteNet:
    """Widths x filters over one-hot bytes, max pooling, softmax."""

    def __init__(self, languages: list[str], seed: int = 7):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.languages = languages
        channels = FILTERS * len(WIDTHS)
        self.params = {f"w{w}": rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.params["bias"] = np.zeros(channels, np.float32)
        self.params["out"] = rng.normal(0, 0.3, (channels, len(languages))).astype(np.float32)
        self.params["top"] = np.zeros(len(languages), np.float32)

    def answers(self, windows, want_places: bool = False):
        import numpy as np

        highest, places = [], []
        for w in WIDTHS:
            kernel = self.params[f"w{w}"]
            n = windows.shape[1] - w + 1
            found = kernel[0][windows[:, :n]]
            for j in range(1, w):
                found += kernel[j][windows[:, j : j + n]]
            if want_places:
                places.append(found.argmax(axis=1))
            highest.append(found.max(axis=1))
        return np.concatenate(highest, axis=1), places

    def softmax(self, pooled):
        import numpy as np

        logits = np.maximum(pooled + self.params["bias"], 0) @ self.params["out"] + self.params["top"]
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        return odds / odds.sum(axis=1, keepdims=True)

    def fit(self, windows, labels, epochs: int = EPOCHS, seed: int = 11) -> ByteNet:
        """Adam on the cross entropy; each language weighs as much as another."""
        import numpy as np

        rng = np.random.default_rng(seed)
        share = np.bincount(labels, minlength=len(self.languages))
        weight = (len(labels) / np.maximum(share, 1) / len(self.languages))[labels].astype(np.float32)
        mean = {k: np.zeros_like(v) for k, v in self.params.items()}
        square = {k: np.zeros_like(v) for k, v in self.params.items()}
        step = 0
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            order = rng.permutation(len(labels))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                x, y = windows[rows], labels[rows]
                pooled, places = self.answers(x, want_places=True)
                active = pooled + self.params["bias"] > 0
                delta = self.softmax(pooled)
                delta[np.arange(len(y)), y] -= 1
                delta *= weight[rows][:, None] / len(y)
                hidden = np.maximum(pooled + self.params["bias"], 0)
                back = (delta @ self.params["out"].T) * active
                grads = {"out": hidden.T @ delta, "top": delta.sum(axis=0), "bias": back.sum(axis=0)}
                for k, w in enumerate(WIDTHS):
                    grad = np.zeros_like(self.params[f"w{w}"])
                    own = back[:, k * FILTERS : (k + 1) * FILTERS]
                    channel = np.broadcast_to(np.arange(FILTERS), own.shape)
                    for j in range(w):
                        seen = np.take_along_axis(x, places[k] + j, axis=1)
                        np.add.at(grad[j], (seen, channel), own)
                    grads[f"w{w}"] = grad
                step += 1
                for name, grad in grads.items():
                    mean[name] += 0.1 * (grad - mean[name])
                    square[name] += 0.001 * (grad * grad - square[name])
                    fixed = mean[name] / (1 - 0.9**step)
                    spread = np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8
                    self.params[name] -= rate * fixed / spread
        return self

    def tables(self):
        """The filters as sums over pairs of bytes: one look-up serves two places."""
        import numpy as np

        first = [self.params[f"w{w}"] for w in WIDTHS]
        heads = np.concatenate([(k[0][:, None] + k[1][None, :]).reshape(65536, FILTERS) for k in first], axis=1)
        third, fourth = first[1][2], (first[2][2][:, None] + first[2][3][None, :]).reshape(65536, FILTERS)
        return np.ascontiguousarray(heads), np.ascontiguousarray(third), np.ascontiguousarray(fourth)

    def predict(self, windows, tables):
        """The softmax of each window, a bounded number of windows at a time."""
        import numpy as np

        heads, third, fourth = tables
        f = FILTERS
        found = []
        for at in range(0, len(windows), CHUNK):
            x = windows[at : at + CHUNK]
            pair = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
            sums = heads[pair]
            two = sums[:, :, :f].max(axis=1)
            three = (sums[:, : WINDOW - 2, f : 2 * f] + third[x[:, 2:]]).max(axis=1)
            four = (sums[:, : WINDOW - 3, 2 * f :] + fourth[pair[:, 2:]]).max(axis=1)
            found.append(self.softmax(np.concatenate([two, three, four], axis=1)))
        return np.concatenate(found)


def sample_windows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, piece): the bounded training sample, windows spread over each text."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(lang_col).alias("lang")
    )
    chosen = bounded_sample(labelled, "lang", "_id", PER_LANGUAGE).select(F.col("_id").alias("_c")).distinct()
    # PER_LANGUAGE ids for each language: bounded, so they are sent to the scan of the texts.
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).join(
        F.broadcast(chosen), F.col("_id") == F.col("_c")
    )
    rest = F.greatest(F.char_length("text") - WINDOW, F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(WINDOWS_PER_TEXT - 1)),
        lambda i: F.substring("text", (i * rest / (WINDOWS_PER_TEXT - 1)).cast("int") + 1, F.lit(WINDOW)),
    )
    return texts.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.explode(F.array_distinct(pieces)).alias("piece")
    )


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteNet | None:
    """The network, fitted on the labelled rows of ``docs``; None without any."""
    import numpy as np
    import pyarrow as pa

    rows = sample_windows(docs, id_col, text_col, lang_col).sort("lang", "piece").collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    data, starts, ends = byte_view(pa.array([r["piece"] for r in rows], pa.string()))
    windows, owner, letters = windows_of(plain_bytes(data), starts, ends)
    labels = np.array([languages.index(r["lang"]) for r in rows])[owner]
    used = letters > 0
    if not used.any():
        return None
    return ByteNet(languages).fit(windows[used], labels[used])


def prediction(net: ByteNet | None):
    """A function of a text column: struct of lang_pred and score, whole texts.

    Only texts go to Python and only answers come back; the rest of a row waits
    on Spark's side."""
    key = "none" if net is None else hashlib.sha256(b"".join(net.params[k].tobytes() for k in sorted(net.params))).hexdigest()

    def run(columns):
        import numpy as np
        import pyarrow as pa

        tables = net and kept_by_worker(f"bytenet {key}", net.tables)
        for texts in columns:
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            if net is not None and len(texts):
                for low, high, data, starts, ends in grouped(texts):
                    windows, owner, letters = windows_of(plain_bytes(data), starts, ends)
                    odds = net.predict(windows, tables) * letters[:, None]
                    sums = np.zeros((high - low, odds.shape[1]))
                    np.add.at(sums, owner, odds)
                    total = np.bincount(owner, letters, minlength=high - low)
                    for i in np.flatnonzero(total):
                        if has_letter(texts[low + i].as_py()):
                            best = int(sums[i].argmax())
                            names[low + i] = net.languages[best]
                            scores[low + i] = min(1.0, sums[i][best] / total[i])
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    run.__annotations__ = {"columns": Iterator[pa_array()], "return": Iterator[pa_array()]}
    return F.arrow_udf(run, "struct<lang_pred:string,score:double>")


def pa_array():
    import pyarrow as pa

    return pa.Array


def predicted(docs: DataFrame, net: ByteNet | None, text: str, *columns: Column | str) -> DataFrame:
    """``columns`` of ``docs`` with lang_pred and score, from whole texts."""
    bounded_batches(docs.sparkSession)
    given = docs.select(*columns, whole_text(text).alias("_text"))
    names = [c for c in given.columns if c != "_text"]
    answered = given.withColumn("_answer", prediction(net)("_text"))
    return answered.select(*names, F.col("_answer.lang_pred").alias("lang_pred"), F.col("_answer.score").alias("score"))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))
