"""Benchmark passages in documents, found in a latent space and then compared.

Terms are words without case and punctuation, hashed into a fixed number of
places.  How many passages of the corpus have a term is counted over all
documents.  The benchmark's passages become unit TF-IDF rows, and a randomised
SVD of these rows, made of sums that Spark adds up over the partitions, gives the
latent space.  Every document is cut into overlapping windows that cover it; each
window is projected and compared by cosine with all passages that just fit into a
window of its length.  A window near a passage, with enough of its words, is then
checked word by word: the longest common subsequence with the passage, and whether
the passage's answer, its last words, is there unchanged.

Benchmark items are taken in blocks of ``BLOCK_ITEMS``, each a pass over the
documents, so what is sent to the tasks is bounded.

Defined results: null and empty texts have no terms and match nothing, as do
items without words; an item of a repeated id counts as further passages of that
id; equal texts match the same items; without items, or without documents, there
are no rows; columns other than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import bounded_batches, whole_text
from threadloom.llm.words import grouped, letters_only, word_hashes

TERMS = 1 << 18
STEP = 16  # words in a block
LONGEST = 64  # words of a passage; longer items have several, half overlapping
RANK = 256  # or the number of passages in a block, if smaller
OVERSAMPLE = 16
ROUNDS = 2
BLOCK_ITEMS = 20_000
# Of the cosine that a window with a copy of the passage would have: no passage asks
# for less.  A passage asks for what its least weighty words give that a candidate
# must cover, see ``gates``.
NEAR = 0.1
# Rounding of sums over a group's blocks, as a share of a copy's cosine.
ROUNDING = 0.01
COMMON = 0.7  # of the passage's words, in order
COMMON_WITH_ANSWER = 0.5
LEAST_COMMON = 6
ANSWER_WORDS = 6
COMPARED = 1 << 20  # windows times passages at once
DENSE = 1 << 22  # passages times terms that a plain table of places holds
SPELLED = 1 << 18  # words of windows compared with passages at once
PROJECTED = 1 << 8  # blocks turned into directions at once
SEED = 17


def terms_of(hashes):
    import numpy as np

    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


def blocks_of(owner, n_texts):
    """(block of each word, owner of each block): blocks start anew in each text."""
    import numpy as np

    counts = np.bincount(owner, minlength=n_texts)
    n_blocks = -(-counts // STEP)
    first_word = np.cumsum(counts) - counts
    first_block = np.cumsum(n_blocks) - n_blocks
    block = first_block[owner] + (np.arange(len(owner)) - first_word[owner]) // STEP
    return block, np.repeat(np.arange(n_texts), n_blocks)


def block_sums(vectors, at, block, n_blocks: int):
    """The sum of the vectors of each block's words.

    ``at`` and ``block`` list words by block; the last of the vectors is zero.  The
    first words of some blocks are added at once, then their second ones, and so on,
    so that sums and vectors stay in the cache."""
    import numpy as np

    counts = np.bincount(block, minlength=n_blocks)
    rows = np.full((STEP, n_blocks), len(vectors) - 1, np.int64)
    rows[np.arange(len(block)) - (np.cumsum(counts) - counts)[block], block] = at
    sums = np.zeros((n_blocks, vectors.shape[1]), vectors.dtype)
    more = np.empty((PROJECTED, vectors.shape[1]), vectors.dtype)
    for low in range(0, n_blocks, PROJECTED):
        some, total = rows[:, low : low + PROJECTED], sums[low : low + PROJECTED]
        for k in range(int(counts[low : low + PROJECTED].max())):
            np.take(vectors, some[k], axis=0, out=more[: len(total)], mode="clip")
            total += more[: len(total)]
    return sums


def block_counts(docs: DataFrame, text_col: str):
    """(number of blocks, blocks that have each term) over all documents."""
    import numpy as np

    bounded_batches(docs.sparkSession)
    def run(batches):
        import pyarrow as pa

        have, total = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for low, high, data, starts, ends in grouped(batch.column(0)):
                hashes, owner, _, _ = word_hashes(letters_only(data), starts, ends)
                if not len(hashes):
                    continue
                block, owners = blocks_of(owner, high - low)
                total += len(owners)
                first = np.searchsorted(block, np.arange(len(owners)))
                rows = np.full((len(owners), STEP), TERMS, np.int32)
                rows[block, np.arange(len(block)) - first[block]] = terms_of(hashes)
                rows.sort(axis=1)
                fresh = rows < TERMS
                fresh[:, 1:] &= rows[:, 1:] != rows[:, :-1]
                have += np.bincount(rows[fresh], minlength=TERMS)
        used = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(have[used], total))], names=["term", "n"])

    counted = docs.select(whole_text(text_col).alias("text")).mapInArrow(run, "term long, n long")
    # One row per term: a fixed number of rows, whatever the corpus.
    found = counted.groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    have = np.zeros(TERMS, np.int64)
    terms, n = found["term"].to_numpy(), found["n"].to_numpy()
    have[terms[terms >= 0]] = n[terms >= 0]
    return int(n[terms < 0].sum()), have


def passages(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words, ends): word hashes of the passages of every item, and whether
    the item ends there, so that the last words are its answer."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ids, found, ends_there = [], [], []
            for low, high, data, starts, ends in grouped(batch.column(1)):
                hashes, owner, _, _ = word_hashes(letters_only(data), starts, ends)
                for i in range(high - low):
                    own = hashes[owner == i].view(np.int64)
                    starts_at = range(0, max(1, len(own) - LONGEST // 2), LONGEST // 2) if len(own) > LONGEST else [0]
                    for at in starts_at if len(own) else []:
                        ids.append(batch.column(0)[low + i].as_py())
                        found.append(own[at : at + LONGEST] if at + 1.5 * LONGEST <= len(own) else own[-LONGEST:] if at else own[:LONGEST])
                        ends_there.append(at == starts_at[-1])
            columns = [pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(ends_there, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "words", "ends"])

    given = items.select(F.col(id_col).cast("long").alias("item_id"), whole_text(text_col).alias("text"))
    return given.mapInArrow(run, "item_id long, words array<long>, ends boolean")


def weighted(words, weights):
    """(row, term, value, norm) of unit TF-IDF rows and their lengths before."""
    import numpy as np

    sizes = np.array([len(w) for w in words])
    row = np.repeat(np.arange(len(words)), sizes)
    term = terms_of(np.concatenate([np.asarray(w, np.int64) for w in words]).view(np.uint64))
    pair, times = np.unique(row * TERMS + term, return_counts=True)
    row, term = pair // TERMS, pair % TERMS
    value = times * weights[term]
    norm = np.sqrt(np.bincount(row, value**2, minlength=len(words)))
    return row, term, value / np.maximum(norm, 1e-12)[row], norm


def term_places(words):
    """(pairs, places): passage and term as one sorted number, and the places of
    the term in the passage as bits, of which ``LONGEST`` are enough."""
    import numpy as np

    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    bit = np.concatenate([np.uint64(1) << np.arange(len(w), dtype=np.uint64) for w in words])
    pair = row * TERMS + terms_of(np.concatenate([np.asarray(w, np.int64) for w in words]).view(np.uint64))
    order = np.argsort(pair, kind="stable")
    heads = np.flatnonzero(np.append(True, pair[order][1:] != pair[order][:-1]))
    return pair[order][heads], np.bitwise_or.reduceat(bit[order], heads)


def gates(words, terms, directions, aims, weights):
    """The least relative cosine with each passage of a window that covers the places
    that a candidate must: each place adds its term's weight times the term's share in
    the passage's latent vector, and the least of these are summed.

    Where the latent space keeps a passage whole, other words add nothing, and this is
    a bound.  Where it does not, words that are not in the passage can take from the
    cosine, and what the space leaves out of the passage's length is subtracted."""
    import numpy as np

    found = np.full(len(words), NEAR)
    for p, own in enumerate(words):
        term, places = np.unique(terms_of(np.asarray(own, np.int64).view(np.uint64)), return_counts=True)
        at = np.searchsorted(terms, term)
        vector = directions[at] @ aims[p]
        # What one occurrence adds, per place it covers.
        adds = np.repeat(weights[term] * vector / places, places)
        unit = places * weights[term]
        lost = 1.0 - float(np.linalg.norm(unit @ directions[at]) / np.linalg.norm(unit)) ** 2
        need = int(np.ceil(COMMON_WITH_ANSWER * len(own)))
        found[p] = max(NEAR, np.sort(adds)[:need].sum() - max(lost, 0.0) - ROUNDING)
    return found


def _product(found: DataFrame, weights, basis_terms, basis, rank: int):
    """AᵀA times a basis, A being the passages' rows: partial sums of each
    partition, added up by term.  ``basis_terms`` None stands for random numbers."""
    import numpy as np

    def run(batches):
        import pandas as pd
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            row, term, value, _ = weighted([w.as_py() for w in batch.column("words")], weights)
            own, place = np.unique(term, return_inverse=True)
            if basis_terms is None:
                start = np.stack([np.random.default_rng((SEED, int(t))).standard_normal(rank) for t in own])
            else:
                start = np.zeros((len(own), rank))
                at = np.minimum(np.searchsorted(basis_terms, own), len(basis_terms) - 1)
                start[basis_terms[at] == own] = basis[at[basis_terms[at] == own]]
            seen = np.zeros((batch.num_rows, rank))
            np.add.at(seen, row, value[:, None] * start[place])
            sums = np.zeros((len(own), rank))
            np.add.at(sums, place, value[:, None] * seen[row])
            frame = pd.DataFrame(sums, columns=[f"x{i}" for i in range(rank)])
            frame.insert(0, "term", own)
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    columns = [f"x{i}" for i in range(rank)]
    parts = found.mapInArrow(run, "term long, " + ", ".join(f"{c} double" for c in columns))
    summed = parts.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns]).toPandas().sort_values("term")
    return summed["term"].to_numpy(), summed[columns].to_numpy()


def latent_space(found: DataFrame, weights, rank: int = RANK, rounds: int = ROUNDS):
    """(terms, directions): a randomised SVD of the passages' rows.

    Collected are the terms of one block of items and a number per term and
    direction, which ``BLOCK_ITEMS`` and ``LONGEST`` bound."""
    import numpy as np

    width = rank + OVERSAMPLE
    terms, basis = None, None
    for _ in range(rounds):
        terms, sums = _product(found, weights, terms, basis, width)
        basis, _ = np.linalg.qr(sums)
        width = basis.shape[1]
    same, image = _product(found, weights, terms, basis, width)
    square = basis.T @ image  # the rows' inner products in the basis
    values, turned = np.linalg.eigh((square + square.T) / 2)
    best = np.argsort(values)[::-1][:rank]
    best = best[values[best] > 1e-9 * max(values.max(), 1e-30)]
    return terms, basis @ turned[:, best]


def common_words(left, right) -> int:
    """The length of the longest common subsequence, bit-parallel."""
    places: dict = {}
    for i, word in enumerate(left):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(left)) - 1
    row = full
    for word in right:
        hit = row & places.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(left) - row.bit_count()


def agree(passage, text, ends: bool = True) -> tuple[float, bool, bool]:
    """(share of the passage's words found in order, answer found, a leak).  A passage
    at whose end its item goes on has no answer."""
    common = common_words(passage, text)
    share = common / len(passage)
    answer = passage[-ANSWER_WORDS:]
    found = ends and any(text[i : i + len(answer)] == answer for i, word in enumerate(text) if word == answer[0])
    enough = common >= min(len(passage), LEAST_COMMON)
    return share, found, enough and (share >= COMMON or (found and share >= COMMON_WITH_ANSWER))


def can_agree(passage, text, ends: bool) -> bool:
    """Whether enough of the passage's words are in the text at all, in any order."""
    within = set(text)
    share = sum(word in within for word in passage) / len(passage)
    if share < COMMON_WITH_ANSWER:
        return False
    return share >= COMMON or (ends and all(word in within for word in passage[-ANSWER_WORDS:]))


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer): documents that hold benchmark passages.

    One row per document and item, with the best window's figures."""
    import numpy as np

    total, have = block_counts(docs, text_col)
    weights = np.log((1.0 + total) / (1.0 + have)) + 1.0
    n_items = items.count()
    blocks = max(1, -(-n_items // BLOCK_ITEMS))
    part = F.pmod(F.xxhash64(item_col, item_text_col), F.lit(blocks))
    results = [_leaks_of(docs, items.where(part == b), weights, id_col, text_col, item_col, item_text_col) for b in range(blocks)]
    whole = results[0]
    for more in results[1:]:
        whole = whole.union(more)
    return whole


def _leaks_of(docs, items, weights, id_col, text_col, item_col, item_text_col) -> DataFrame:
    import numpy as np

    found = passages(items, item_col, item_text_col)
    rows = found.sort("item_id", "words", "ends").collect()  # one block of items
    schema = "doc_id long, item_id long, cosine double, common double, answer boolean"
    if not rows:
        return docs.sparkSession.createDataFrame([], schema)
    terms, directions = latent_space(found, weights)
    words = [r["words"] for r in rows]
    item_ids, ends_there = [r["item_id"] for r in rows], [r["ends"] for r in rows]
    # A passage's place in the latent space, and how much of its length is kept there.
    row, term, value, norm = weighted(words, weights)
    items_at = np.zeros((len(words), directions.shape[1]))
    np.add.at(items_at, row, value[:, None] * directions[np.searchsorted(terms, term)])
    captured = np.linalg.norm(items_at, axis=1)
    # A window of length x that holds a copy has a cosine of norm / x with the passage.
    aims = items_at / (np.maximum(captured, 1e-12) ** 2 * norm)[:, None]
    least = gates(words, terms, directions, aims, weights).astype(np.float32)
    aims = aims.astype(np.float32)
    # The number of blocks that hold a passage of so many words wherever it begins.
    spans = np.array([-(-(len(w) - 1) // STEP) + 1 for w in words])
    groups = [(int(g), np.flatnonzero(spans == g)) for g in sorted(set(spans.tolist()))]
    pairs, places = term_places(words)
    lengths = np.array([len(w) for w in words])
    # How many places of a passage one word can cover.
    most_places = np.array([max(w.count(x) for x in set(w)) for w in words])
    vectors = np.append(weights[terms][:, None] * directions, np.zeros((1, directions.shape[1])), axis=0).astype(np.float32)
    weight = weights.astype(np.float32)

    def run(batches):
        import pyarrow as pa

        place = np.full(TERMS, -1, np.int32)
        place[terms] = np.arange(len(terms))
        dense = None
        if len(words) * len(terms) <= DENSE:
            dense = np.zeros((len(words), len(terms)), np.uint64)
            dense[pairs // TERMS, place[pairs % TERMS]] = places
        for batch in batches:
            out = ([], [], [], [], [])
            for low, high, data, starts, ends in grouped(batch.column(1)):
                hashes, owner, _, _ = word_hashes(letters_only(data), starts, ends)
                if not len(hashes):
                    continue
                block, owners = blocks_of(owner, high - low)
                term = terms_of(hashes)
                at = place[term]
                known = np.flatnonzero(at >= 0)
                n = len(owners)
                # Sums over the blocks before each block: a window is a difference of two.
                # Those of cosines are made for some blocks and passages at a time.
                energy = np.append(0, np.cumsum(np.bincount(block, weight[term] ** 2, minlength=n)))
                seen = block_sums(vectors, at[known], block[known], n)
                blocks_in = np.bincount(owners, minlength=high - low)
                left = (np.cumsum(blocks_in) - blocks_in)[owners]
                last = left + blocks_in[owners]
                firsts = np.searchsorted(block, np.arange(n + 1))
                known_firsts = np.searchsorted(known, firsts)
                best: dict = {}
                for span, group in groups:
                    # A window starts at every block that has the span before the text's end.
                    start = np.flatnonzero((np.arange(n) + span <= last) | (np.arange(n) == left))
                    stop = np.minimum(start + span, last[start])
                    aimed, at_once = aims[group].T, max(1, COMPARED // len(group))
                    for k in range(0, len(start), at_once):
                        a, b = start[k : k + at_once], stop[k : k + at_once]
                        upto = np.zeros((b[-1] - a[0] + 1, len(group)))
                        np.cumsum(seen[a[0] : b[-1]] @ aimed, axis=0, out=upto[1:])
                        relative = (upto[b - a[0]] - upto[a - a[0]]).astype(np.float32)
                        row, column = np.nonzero(relative >= least[group])
                        # A window with fewer known words than a candidate must cover is none.
                        counts = known_firsts[b[row]] - known_firsts[a[row]]
                        enough = counts * most_places[group[column]] >= COMMON_WITH_ANSWER * lengths[group[column]]
                        row, column, counts = row[enough], column[enough], counts[enough]
                        p, a, b, relative = group[column], a[row], b[row], relative[row, column]
                        # What the window can have of the passage: the places of the terms it has.
                        covered = np.zeros(len(a), np.uint64)
                        upto = np.cumsum(counts)
                        done = 0
                        while done < len(a):
                            stop_at = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + SPELLED, "right")))
                            some = slice(done, stop_at)
                            own = counts[some]
                            heads = np.cumsum(own) - own
                            word = known[np.arange(own.sum()) + np.repeat(known_firsts[a[some]] - heads, own)]
                            if dense is not None:
                                bits = dense[np.repeat(p[some], own), at[word]]
                            else:
                                pair = np.repeat(p[some], own) * TERMS + term[word]
                                hit = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
                                bits = np.where(pairs[hit] == pair, places[hit], np.uint64(0))
                            covered[some] = np.bitwise_or.reduceat(bits, heads)
                            done = stop_at
                        for i in np.flatnonzero(np.bitwise_count(covered) >= COMMON_WITH_ANSWER * lengths[p]):
                            text, passage = int(owners[a[i]]), int(p[i])
                            key = (text, item_ids[passage])
                            if key in best and best[key][0] >= 1.0:
                                continue
                            lo = firsts[max(a[i] - 1, left[a[i]])]
                            hi = firsts[min(b[i] + 1, last[a[i]])]
                            near = hashes[lo:hi].view(np.int64).tolist()
                            if not can_agree(words[passage], near, ends_there[passage]):
                                continue
                            share, answer, leak = agree(words[passage], near, ends_there[passage])
                            if leak and (key not in best or share > best[key][0]):
                                size = (energy[b[i]] - energy[a[i]]) ** 0.5
                                best[key] = (share, float(relative[i] * norm[passage] / size), answer)
                for (text, item), (share, cosine_, answer) in sorted(best.items(), key=lambda x: (x[0][0], str(x[0][1]))):
                    for column, v in zip(out, (batch.column(0)[low + text].as_py(), item, min(1.0, cosine_), share, answer)):
                        column.append(v)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds)], names=["doc_id", "item_id", "cosine", "common", "answer"]
            )

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return given.mapInArrow(run, schema)
