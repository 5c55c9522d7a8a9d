"""Words of many texts at once, as 64-bit hashes computed with numpy.

A word is a run of bytes without ASCII white space, A-Z in lower case.  The hash
of a word comes out of prefix sums over the bytes, so nothing loops over words.
Texts are worked through in groups of a bounded number of bytes.
"""

from __future__ import annotations

from threadloom.llm.common import byte_view, kept_by_worker

GROUP_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
MASK = (1 << 64) - 1


def mixed(x):
    """A bijection of 64-bit integers that spreads every bit (the finalizer of MurmurHash3)."""
    import numpy as np

    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _tables():
    import numpy as np

    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    values[65:91] = values[97:123]
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    return {"values": values, "blank": blank, "powers": None}


def _powers(tables, n):
    import numpy as np

    if tables["powers"] is None or len(tables["powers"][0]) < n:
        size = max(n, GROUP_BYTES + 1)
        both = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        if size > 8 * GROUP_BYTES:
            return both  # for one very long text; not kept
        tables["powers"] = both
    return tables["powers"]


def word_hashes(data, starts, ends):
    """(hashes, owner, begin, end) of all words; owner is the index of the text,
    begin and end are places in ``data``.  Texts lie one behind the other."""
    import numpy as np

    tables = kept_by_worker("words", _tables)
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    solid = ~tables["blank"][data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cuts = starts[ends > starts]
    begins[cuts] = solid[cuts]
    last = np.empty(n, bool)
    last[:-1] = solid[:-1] & (~solid[1:] | begins[1:])
    last[-1] = solid[-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(last) + 1
    up, down = _powers(tables, n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(tables["values"][data] * up[:n], out=sums[1:])
    hashes = mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    full = np.flatnonzero(ends > starts)
    owner = full[np.searchsorted(starts[full], begin, "right") - 1]
    return hashes, owner, begin, end


def grouped(texts):
    """(low, high, data, starts, ends) for runs of texts of an Arrow column that
    hold a bounded number of bytes, one text at least."""
    import numpy as np

    data, starts, ends = byte_view(texts)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + GROUP_BYTES, "right")))
        at = starts[low]
        yield low, high, data[at : ends[high - 1]], starts[low:high] - at, ends[low:high] - at
        low = high


def shingle_hashes(hashes, owner, n_texts: int, size: int):
    """(shingles, owner): hashes of ``size`` successive words, and for a text of
    fewer words the hash of them all."""
    import numpy as np

    counts = np.bincount(owner, minlength=n_texts)
    firsts = np.cumsum(counts) - counts
    if not len(hashes):
        return hashes, owner
    place = np.arange(len(hashes)) - firsts[owner]
    kept = (place + size <= counts[owner]) | (place == 0)
    at = np.flatnonzero(kept)
    short = counts[owner[at]] < size
    total = np.full(len(at), size, np.uint64)
    for k in range(size):
        inside = at + k
        if short.any():
            present = k < counts[owner[at]]
            part = np.where(present, hashes[np.minimum(inside, len(hashes) - 1)], np.uint64(0))
        else:
            part = hashes[inside]
        total = mixed(total * np.uint64(BASE) + part)
    return total, owner[at]


def distinct_by_text(values, owner):
    """(values, owner) without repeats inside a text, sorted by text, then value."""
    import numpy as np

    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[fresh], owner[fresh]


def letters_only(data):
    """The bytes with ASCII punctuation as blanks and Latin-1 capitals in lower case."""
    import numpy as np

    table = np.arange(256, dtype=np.uint8)
    for i in range(128):
        if not chr(i).isalnum():
            table[i] = 32
    plain = table[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        plain[1:][capital] += 0x20
    return plain
