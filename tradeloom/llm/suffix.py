"""Passages that repeat across documents, by a hash-compared suffix sort.

Every byte covered by a 50-byte string that also starts in a document with a
smaller id is removed. The 50-byte windows are shared out by an anchor: of the
20-byte strings inside a window, the one with the smallest hash, the leftmost of
equal ones. Equal windows have equal anchors at equal places, so windows only
have to be compared within one anchor string. Neighbouring windows with the same
anchor form a run.

1. Runs with the same anchor and the same content (48 bits of a hash of it, besides
   32 bits and the bucket of the anchor's) are covered by the document with the smallest id. Runs
   whose anchor also occurs with other content, in another document, go on, one
   for each content.
2. Their bytes are fetched. The suffixes that begin at the anchors are sorted by
   mergesort; two suffixes are compared by binary search for their longest common
   extension, on prefix polynomial hashes. A window reaches o bytes left of its
   anchor: suffixes whose neighbours share 50 - o bytes form a block, and equal
   hashes of the o bytes to the left split it into groups of equal windows. All
   equalities are then checked on the bytes; a collision repeats the work with
   another base.

Records travel packed, many to a row: runs by bucket of their anchor, spans by bucket
of their document, so that rows follow the bytes, about BUCKET of them to a bucket. A
map task sends only the smallest document of each content and settles the others
itself, so copies do not gather in one place. Distinct contents around one anchor
string meet in one task; they are a few dozen bytes each.

A row is known by its id and a 64-bit hash of its text. A null text is empty. A null id
ranks below all others. Rows with the same id do not cover each other, so that all rows
of one id and text have one result. Texts under 50 bytes are unchanged. An empty table
gives an empty result; other columns are not looked at.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.staging import settle
from tradeloom.llm.text import fresh, in_arrow, lean, quoted, texts

NO_ID = -(2**63)
WINDOW, ANCHOR = 50, 20
#: Bytes of a text handled at once; pieces overlap, so that no window is lost.
PIECE = 262_144
#: Runs of a task that are packed and sent together, and bytes of packed records in one bucket.
RUNS_PER_BLOB, BUCKET = 200_000, 12_000_000
#: Bytes of packed records for a byte of text.
PACKED = 1.4
SEEDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAAAAAAAB55555555 | 1)
#: ``s`` and ``t`` are 48 bits of the content's hash.
RUN = np.dtype([("h", "<u4"), ("s", "<u4"), ("t", "<u2"), ("lo", "<u4"), ("da", "u1"), ("dh", "u1")])
WHO = np.dtype([("doc", "<i8"), ("tag", "<i8")])
SPAN = np.dtype([("lo", "<u4"), ("size", "<u4")])
OPEN = np.dtype([("h", "<u8"), ("lo", "<u4"), ("da", "<u2"), ("dh", "<u2")])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Polynomial hashes of substrings modulo 2^64, from prefix sums."""

    def __init__(self, size: int, turn: int = 0):
        base = SEEDS[turn % len(SEEDS)] + 8 * turn
        self.letter = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
        steps = lambda b: np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))))
        self.up, self.down = steps(base), steps(pow(base, -1, 2**64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.letter[data] * self.up[: len(data)])))


def runs(data: np.ndarray, prefix: Prefix) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, first and last window start, and anchor of every run."""
    span = WINDOW - ANCHOR + 1
    sums = prefix.sums(data)
    grams = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * prefix.down[: len(data) - ANCHOR + 1])
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    low = np.uint64(0xFFFFFF)
    least, reach = (grams & ~low) | np.arange(len(grams), dtype=np.uint64), 1
    while 2 * reach <= span:
        least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
    if reach < span:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    chosen = (least & low).astype(np.int64)
    edge = np.flatnonzero(chosen[1:] != chosen[:-1])
    lo, hi = np.concatenate(([0], edge + 1)), np.concatenate((edge, [len(chosen) - 1]))
    anchor = chosen[lo]
    shape = ((anchor - lo) * 64 + (hi - lo)).astype(np.uint64)
    content = mix((sums[hi + WINDOW] - sums[lo]) * prefix.down[lo] + mix(shape + np.uint64(1)))
    return grams[anchor], content, lo, hi, anchor


def text_runs(text: bytes, prefix: Prefix):
    """``runs`` of a whole text, piece by piece, places counted from its begin."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(1, len(data) - WINDOW + 1), PIECE):
        piece = data[at : at + PIECE + WINDOW - 1]
        if len(piece) >= WINDOW:
            h, s, lo, hi, anchor = runs(piece, prefix)
            yield h, s, lo + at, hi + at, anchor + at


def _first(*columns: np.ndarray) -> np.ndarray:
    """Marks of rows that differ from the row before in a column."""
    mark = np.ones(len(columns[0]), bool)
    if len(mark):
        mark[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return mark


def by_document(who: np.ndarray, owner: np.ndarray, rows: np.ndarray) -> bytes:
    """Rows packed with the documents that they belong to; ``owner`` holds places in ``who``.

    Ids go as distances from the smallest; these and the counts of rows take as few bytes as they can.
    """
    used, owner = np.unique(owner, return_inverse=True)
    order = np.argsort(owner, kind="stable")
    base = who["doc"][used].min(initial=2**63 - 1)
    numbers = [who["doc"][used].astype(np.uint64) - np.array(base).astype(np.uint64), np.bincount(owner, minlength=len(used)).astype(np.uint64)]
    kinds = [np.min_scalar_type(int(x.max(initial=0))).newbyteorder("<") for x in numbers]
    head = np.array([len(used), base, *[k.itemsize for k in kinds]], "<i8")
    narrow = [x.astype(k).tobytes() for x, k in zip(numbers, kinds)]
    return b"".join([head.tobytes(), *narrow, who["tag"][used].tobytes(), rows[order].tobytes()])


def documents_of(blobs: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(who, owner, rows) of packed rows laid end to end."""
    who, owner, rows, at = [np.zeros(0, WHO)], [np.zeros(0, np.int64)], [np.zeros(0, kind)], 0
    for blob in blobs:
        n, base, *sizes = np.frombuffer(blob, "<i8", 4).tolist()
        begin, numbers = 32, []
        for size in sizes:
            numbers.append(np.frombuffer(blob, f"<u{size}", n, begin))
            begin += n * size
        names = np.empty(n, WHO)
        names["doc"] = (numbers[0].astype(np.uint64) + np.array(base).astype(np.uint64)).astype(np.int64)
        names["tag"] = np.frombuffer(blob, "<i8", n, begin)
        who.append(names)
        owner.append(np.repeat(np.arange(at, at + n), numbers[1].astype(np.int64)))
        rows.append(np.frombuffer(blob, kind, offset=begin + 8 * n))
        at += n
    return np.concatenate(who), np.concatenate(owner), np.concatenate(rows)


def home(who: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each document."""
    mixed = mix(who["doc"].astype(np.uint64) ^ mix(who["tag"].astype(np.uint64)))
    return (mixed % np.uint64(buckets)).astype(np.int64)


def _packed(parts: list, buckets: int):
    """Rows (bucket, runs, settled) of the runs of many documents."""
    who = np.array([p[5] for p in parts], WHO)
    h, s, lo, hi, anchor = (np.concatenate([p[k] for p in parts]) for k in range(5))
    owner = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p[0]) for p in parts])
    runs_ = np.empty(len(h), RUN)
    runs_["h"], runs_["s"], runs_["t"] = h & np.uint64(0xFFFFFFFF), s & np.uint64(0xFFFFFFFF), s >> np.uint64(48)
    runs_["lo"], runs_["da"], runs_["dh"] = lo, anchor - lo, hi - lo
    bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint32)
    del h, s, lo, hi, anchor
    order = np.lexsort((who["doc"][owner], runs_["t"], runs_["s"], runs_["h"], bucket))
    runs_, owner, bucket = runs_[order], owner[order], bucket[order]
    begins = _first(bucket, runs_["h"], runs_["s"], runs_["t"])
    doc = who["doc"][owner]
    late = doc != doc[np.flatnonzero(begins)][np.cumsum(begins) - 1]
    edges = np.append(np.flatnonzero(_first(bucket)), len(bucket))
    for begin, end in zip(edges[:-1], edges[1:]):
        some, names, done = runs_[begin:end], owner[begin:end], late[begin:end]
        yield int(bucket[begin]), by_document(who, names[~done], some[~done]), by_document(who, names[done], _spans(some[done]))


def _spans(runs_: np.ndarray) -> np.ndarray:
    spans = np.empty(len(runs_), SPAN)
    spans["lo"], spans["size"] = runs_["lo"], runs_["dh"].astype(np.uint32) + WINDOW
    return spans


def anchor_runs(docs: DataFrame, buckets: int) -> DataFrame:
    def rows(batches):
        prefix, parts, held = Prefix(PIECE + WINDOW), [], 0
        for batch in batches:
            for doc, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch)):
                for found in text_runs(text, prefix):
                    parts.append((*found, (doc, tag)))
                    held += len(found[0])
                    if held >= RUNS_PER_BLOB:
                        yield from _packed(parts, buckets)
                        parts, held = [], 0
        if parts:
            yield from _packed(parts, buckets)

    return in_arrow(docs, rows, "bucket int, runs binary, settled binary", flush=16)


HOMED = "home int, spans binary, open binary"


def _homed(who: np.ndarray, parts: dict, buckets: int) -> pd.DataFrame:
    """Rows of HOMED: each column's (owner, rows), by the documents' buckets."""
    place, out = home(who, buckets), {}
    for name, (owner, rows) in parts.items():
        at = place[owner]
        order = np.argsort(at, kind="stable")
        at, owner, rows = at[order], owner[order], rows[order]
        edges = np.append(np.flatnonzero(_first(at)), len(at))
        for begin, end in zip(edges[:-1], edges[1:]):
            out.setdefault(int(at[begin]), {})[name] = by_document(who, owner[begin:end], rows[begin:end])
    return pd.DataFrame([(k, v.get("spans"), v.get("open")) for k, v in out.items()], columns=["home", "spans", "open"])


def match_runs(bucket: int, frame: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Covered spans and open runs of one bucket, packed by the buckets of their documents."""
    who, owner, runs_ = documents_of(frame["runs"].tolist(), RUN)
    order = np.lexsort((who["doc"][owner], runs_["t"], runs_["s"], runs_["h"]))
    runs_, owner = runs_[order], owner[order]
    doc = who["doc"][owner]
    new_h, new_s = _first(runs_["h"]), _first(runs_["h"], runs_["s"], runs_["t"])
    late = doc > doc[np.flatnonzero(new_s)][np.cumsum(new_s) - 1]
    begins = np.flatnonzero(new_h)
    contents = np.add.reduceat(new_s.astype(np.int64), begins)
    mixed = (contents > 1) & (np.minimum.reduceat(doc, begins) < np.maximum.reduceat(doc, begins))
    # Nothing covers rows without an id: one of a content speaks for all.
    goes_on = mixed[np.cumsum(new_h) - 1] & ~late & (new_s | (doc != NO_ID))
    go_on = runs_[goes_on]
    open_ = np.empty(len(go_on), OPEN)
    open_["h"] = go_on["h"].astype(np.uint64) | (np.uint64(bucket) << np.uint64(32))
    open_["lo"], open_["da"], open_["dh"] = go_on["lo"], go_on["da"], go_on["dh"]
    settled, of_settled, spans = documents_of(frame["settled"].tolist(), SPAN)
    of_spans = np.concatenate((owner[late], of_settled + len(who)))
    parts = {"spans": (of_spans, np.concatenate((_spans(runs_[late]), spans))), "open": (owner[goes_on], open_)}
    return _homed(np.concatenate((who, settled)), parts, buckets)


def merged(homed: DataFrame) -> DataFrame:
    """One row for each document: doc, tag, maximal spans, and its open runs."""

    def rows(batches):
        now, held = None, []
        for batch in batches:
            for key, *blobs in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if held and key != now:
                    yield from _merged(held)
                    held = []
                now = key
                held.append(blobs)
        if held:
            yield from _merged(held)

    sorted_ = homed.repartition("home").sortWithinPartitions("home").select("home", "spans", "open")
    return in_arrow(sorted_, rows, "doc long, tag long, spans binary, open binary", flush=2000)


def _merged(held: list):
    found: dict = {}
    for k, kind in ((0, SPAN), (1, OPEN)):
        who, owner, rows = documents_of([blobs[k] for blobs in held if blobs[k]], kind)
        order = np.lexsort((who["tag"], who["doc"]))
        new = _first(who["doc"][order], who["tag"][order])
        place = np.empty(len(who), np.int64)
        place[order] = np.cumsum(new) - 1
        names, owner = who[order[new]], place[owner]
        if k == 0:
            owner, rows = maximal(owner, rows)
        else:  # rows of one id and text have the same runs
            order = np.lexsort((rows["lo"], owner))
            owner, rows = owner[order], rows[order]
            once = _first(owner, rows["lo"])
            owner, rows = owner[once], rows[once]
        edges = np.append(np.flatnonzero(_first(owner)), len(owner)).tolist()
        keys = names[owner[edges[:-1]]].tolist()
        for key, begin, end in zip(keys, edges[:-1], edges[1:]):
            found.setdefault(key, [None, None])[k] = rows[begin:end].tobytes()
    for (doc, tag), (spans, open_) in found.items():
        yield doc, tag, spans, open_


def maximal(owner: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of each owner united to maximal ones, in order."""
    order = np.lexsort((spans["lo"], owner))
    owner, spans = owner[order], spans[order]
    # The owner's number in the high bits keeps the places of different owners apart.
    begin = (owner.astype(np.int64) << 33) + spans["lo"]
    reach = np.maximum.accumulate(begin + spans["size"]) if len(begin) else begin
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    at = np.flatnonzero(new)
    out = np.empty(len(at), SPAN)
    last = np.append(at[1:] - 1, len(begin) - 1) if len(at) else at
    out["lo"], out["size"] = spans["lo"][at], reach[last] - begin[at]
    return owner[at], out


def contexts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The bytes of open runs: bucket, h, doc, tag, lo, da, dh, content."""
    wanted = found.filter("open is not null").select("doc", "tag", "open")
    both = docs.join(wanted, ["doc", "tag"]).select("doc", "tag", "open", "text")

    def rows(batches):
        for batch in batches:
            for doc, tag, open_, text in zip(*(batch.column(k).to_pylist() for k in range(3)), texts(batch)):
                for run in np.frombuffer(open_, OPEN):
                    h, lo, da, dh = (int(run[c]) for c in OPEN.names)
                    yield h >> 32, h - 2**63, doc, tag, lo, da, dh, text[lo : lo + dh + WINDOW]

    return in_arrow(both, rows, "bucket int, h long, doc long, tag long, lo long, da int, dh int, content binary")


class Suffixes:
    """Suffixes of contents laid end to end, sorted within groups by common extensions."""

    def __init__(self, contents: list[bytes], da: np.ndarray, turn: int):
        self.size = np.array([len(c) for c in contents])
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(contents), np.uint8)
        self.prefix = Prefix(len(self.data), turn)
        self.sums = self.prefix.sums(self.data)
        self.start, self.end = self.begin + da, self.begin + self.size

    def hash(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.prefix.down[at]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common extension of the suffixes i and j, by binary search."""
        x, y = self.start[i], self.start[j]
        most = np.minimum(self.end[i] - x, self.end[j] - y)
        size = np.zeros(len(i), np.int64)
        for step in (64, 32, 16, 8, 4, 2, 1):
            able = np.flatnonzero(size + step <= most)
            same = self.hash(x[able] + size[able], step) == self.hash(y[able] + size[able], step)
            size[able[same]] += step
        return size

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i comes before suffix j; equal ones do not."""
        size = self.common(i, j)
        x, y = self.start[i] + size, self.start[j] + size
        ended_i, ended_j = x >= self.end[i], y >= self.end[j]
        last = len(self.data) - 1
        return np.where(ended_i, ~ended_j, ~ended_j & (self.data[np.minimum(x, last)] < self.data[np.minimum(y, last)]))

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes by group and content; ``group`` is ascending.

        Bottom-up mergesort of all groups at once: an element's new place is its own
        plus the number of elements of the other run before it, found by bisection.
        """
        n = len(group)
        begins = np.flatnonzero(_first(group))
        counts = np.diff(np.append(begins, n))
        base, count = np.repeat(begins, counts), np.repeat(counts, counts)
        order = np.arange(n)
        width = 1
        while width < (counts.max() if n else 0):
            at = np.flatnonzero(count > width)
            within = at - base[at]
            left = (within // width) % 2 == 0
            other = np.where(left, within // width + 1, within // width - 1) * width
            low = np.minimum(other, count[at])
            high = np.minimum(other + width, count[at])
            first, offset = low.copy(), within % width
            while True:
                todo = np.flatnonzero(low < high)
                if not len(todo):
                    break
                middle = (low[todo] + high[todo]) // 2
                mine, theirs = order[at[todo]], order[base[at[todo]] + middle]
                # Stable: a right element comes after equal left ones.
                before = np.where(left[todo], self.less(theirs, mine), ~self.less(mine, theirs))
                low[todo] = np.where(before, middle + 1, low[todo])
                high[todo] = np.where(before, high[todo], middle)
            start = np.where(left, within - offset, other)
            new = order.copy()
            new[base[at] + start + offset + (low - first)] = order[at]
            order, width = new, 2 * width
        return order


def equal_windows(frame: dict, turn: int = 0) -> np.ndarray | None:
    """Marks (contents x offsets) of windows that a smaller document has; None after a collision."""
    h, doc, da, dh, contents = (frame[k] for k in ("h", "doc", "da", "dh", "content"))
    n, widest = len(h), WINDOW - ANCHOR + 1
    marks = np.zeros((n, widest), bool)
    if not n:
        return marks
    tool = Suffixes(contents, da, turn)
    order = tool.sort(np.cumsum(_first(h)) - 1)
    shared = np.zeros(n, np.int64)  # with the suffix before
    shared[1:] = tool.common(order[1:], order[:-1])
    limit = 2 * WINDOW
    table = np.zeros((n, limit), np.uint8)  # right parts, to check the hashes on the bytes
    places = np.arange(limit)
    at = tool.start[order][:, None] + places
    inside = at < tool.end[order][:, None]
    table[inside] = tool.data[at[inside]]
    alike = (table[1:] == table[:-1]) | (places >= shared[1:, None])
    if not alike.all():
        return None
    for o in range(widest):
        has = (da[order] >= o) & (da[order] - o <= dh[order])
        # A neighbour without such a window still passes on the common prefix.
        block = np.cumsum(shared < WINDOW - o)
        rows = np.flatnonzero(has)
        if len(rows) < 2:
            continue
        left = tool.start[order[rows]] - o
        key, who = tool.hash(left, o), doc[order[rows]]
        by = np.lexsort((who, key, block[rows]))
        rows, key, left, who = rows[by], key[by], left[by], who[by]
        begins = _first(block[rows], key)
        head = np.flatnonzero(begins)[np.cumsum(begins) - 1]
        for k in range(o):
            if (tool.data[left + k] != tool.data[left[head] + k]).any():
                return None
        late = who > who[head]
        marks[order[rows[late]], o] = True
    return marks


def match_contents(frame: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Spans of windows covered by a smaller document, of one bucket."""
    # Rows of one id and text have the same runs.
    frame = frame.drop_duplicates(["h", "doc", "tag", "lo"]).sort_values(["h", "doc", "lo"], kind="stable")
    columns = {k: frame[k].to_numpy() for k in ("h", "doc", "tag", "lo", "da", "dh")}
    columns["content"] = frame["content"].tolist()
    turn, marks = 0, None
    while marks is None:
        marks, turn = equal_windows(columns, turn), turn + 1
    row, o = np.nonzero(marks)
    spans = np.zeros(len(row), SPAN)
    spans["lo"], spans["size"] = columns["lo"][row] + columns["da"][row] - o, WINDOW
    who = np.empty(len(frame), WHO)
    who["doc"], who["tag"] = columns["doc"], columns["tag"]
    return _homed(who, {"spans": (row, spans)}, buckets)


def union(spans: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs (begin, end) of the bytes that spans cover."""
    _, out = maximal(np.zeros(len(spans), np.int64), spans)
    return [(b, min(b + n, size)) for b, n in zip(out["lo"].tolist(), out["size"].tolist())]


def bucket_count(docs: DataFrame) -> int:
    """Buckets of about BUCKET bytes of packed records."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(1, -int(-size * PACKED // BUCKET))


def repeated_spans(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc, tag and packed spans (lists of SPAN rows, which may overlap) of the bytes to remove.

    ``docs`` has doc, tag and text, as ``identified`` gives them. There is one row for each id and text.
    """
    n = buckets or bucket_count(docs)
    of_runs = anchor_runs(docs, n).groupBy("bucket").applyInPandas(lambda key, frame: lean(match_runs, int(key[0]), frame, n), HOMED)
    first = settle(merged(of_runs), "runs")
    of_contents = contexts(docs, first).groupBy("bucket").applyInPandas(lambda key, frame: lean(match_contents, frame, n), HOMED)
    second = settle(merged(of_contents), "windows")
    both = first.union(second).filter("spans is not null")
    return both.groupBy("doc", "tag").agg(F.collect_list("spans").alias("spans"))


def name_columns() -> tuple:
    """A row's ranked id, and the hash that tells the texts of one id apart."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce("text", F.lit("")))


def identified(docs: DataFrame) -> DataFrame:
    """doc (ranked id), tag (hash of the text) and text."""
    doc, tag = name_columns()
    return docs.select(doc.alias("doc"), tag.alias("tag"), F.coalesce("text", F.lit("")).alias("text"))


def remove_repeats(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed spans, for every row of ``docs``."""
    named = identified(docs)
    both = named.join(repeated_spans(named, buckets), ["doc", "tag"], "left").select("doc", "text", "spans")

    def rows(batches):
        for batch in batches:
            for doc, text, lists in zip(batch.column(0).to_pylist(), texts(batch), batch.column(2).to_pylist()):
                gone = union(np.frombuffer(b"".join(lists or []), SPAN), len(text))
                kept = cut(text, gone)
                n = len(text) - len(kept)
                yield None if doc == NO_ID else doc, len(text), n, len(gone), hashlib.sha256(kept).hexdigest(), [list(g) for g in gone]

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    return in_arrow(both, rows, schema)


def cut(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for begin, end in gone:
        kept.append(text[at:begin])
        at = end
    return b"".join([*kept, text[at:]])


def deduplicate(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the texts; other columns stay.

    Bytes of a character that is cut in two are dropped. A null text stays null.
    """
    doc, tag, found = (fresh(docs, name) for name in ("doc", "tag", "spans"))
    ranked, hashed = name_columns()
    named = docs.select("*", ranked.alias(doc), hashed.alias(tag))
    spans = repeated_spans(identified(docs), buckets).toDF(doc, tag, found)
    both = named.join(spans, [doc, tag], "left")
    shorten = F.arrow_udf(_shortened, "string")
    text = F.when(F.col(found).isNull(), F.col("text")).otherwise(shorten("text", found))
    return both.withColumn("text", text).select(*quoted(docs))


def _shortened(text, spans):
    import pyarrow as pa

    out = []
    for body, lists in zip(text.cast(pa.binary()).to_pylist(), spans.to_pylist()):
        if body is not None and lists:
            body = cut(body, union(np.frombuffer(b"".join(lists), SPAN), len(body))).decode("utf-8", "ignore").encode()
        out.append(body)
    return pa.array(out, pa.binary()).cast(pa.string())
