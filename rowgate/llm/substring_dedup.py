"""Substring dedup by relative Lempel-Ziv parsing against reference blocks.

Text that is repeated is found as long factors: a document is parsed from left
to right, each factor the longest match with earlier text.  Its alphabet here
is the *window*, 20 consecutive words, so that a factor of ``m`` windows is a
match of ``m + 19`` words and no factor is too short to count.  Where a factor
ends, the windows across its boundary are parsed like all others.

Which block a piece of text must be parsed against is decided by content: every
window has an *anchor*, the smallest hash of the 8-word runs in it, and equal
windows have equal anchors.  A *fragment* is a run of windows of a document with
one anchor; a *reference block* holds the fragments of a range of anchors, and a
fragment can only match in the block of its anchor.  So parsing each fragment
against its block, in the order of documents and positions, is parsing each
document against every indexed block that can match.  In a block, the fragments
of an anchor are indexed window by window as they are parsed: a match is
extended along the reference fragment, and what has none is added to the index.

Anchors that occur once can't match and are dropped first (a count over
anchors).  An anchor of more than ``HOT`` occurrences is not parsed by one task:
its fragments are folded by content, their first place aggregated on the map side,
and so are the windows of the different fragments.  A window of a hot anchor is a
repeat wherever it isn't the first of its kind; so what goes back to a text is
where its hot fragments lie, and which of its windows are firsts - never a row for
every repeat.  This is exact too.

Equality is that of two 64-bit hashes, of the anchor and of the window.

Defined cases: a null or empty text has no words; a very long text is parsed like
any other, its fragments by themselves; extra columns, whatever their names, are
carried by :func:`dedup_documents` and play no part; documents are ordered by id,
null ids last, and by a hash of their text where ids are equal; rows equal in
both are one place, so neither is a repeat of the other; every input row gives
one result row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowgate.llm.common import gram_hashes, map_batches, map_rows, pieces, quoted, runs, staged, table, word_hashes, words_of

#: Words of a window, and of an anchor.
WINDOW = 20
ANCHOR = 8
#: Occurrences of an anchor above which its windows are compared by aggregation.
HOT = 5000
#: A fragment's place: its first window times this, and its windows (at most WINDOW - ANCHOR + 1).
PLACE = 16
#: Order of rows without an id: after all others.
NO_ID = (1 << 63) - 1
_LINE_BLANKS = b" \t\n\x0b\x0c\r"


def anchors(h: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of a document of word hashes: anchor hash, first window, windows.

    A window's anchor is the leftmost smallest of its runs, so it depends on the
    window's words only.
    """
    if len(h) < window:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none
    grams = gram_hashes(h, anchor)
    span = window - anchor + 1
    at = np.arange(len(h) - window + 1)
    best, place = grams[at], at.copy()
    for k in range(1, span):
        g = grams[at + k]
        less = g < best
        best[less] = g[less]
        place[less] = (at + k)[less]
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return best[first], first, np.diff(np.append(first, len(at)))


def text_tie(text: str | None) -> int:
    """Order of rows with equal ids; the value of Spark's ``xxhash64``."""
    n = xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass"), 42)
    return n - (1 << 64) if n >> 63 else n


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("at", pa.int64())])
    for batch in batches:
        for part in pieces(batch):
            found = [(anchors(word_hashes(words_of(t))), k) for k, t in zip(part.column("key").to_pylist(), part.column("text").to_pylist())]
            found = [(a, s, n, k) for (a, s, n), k in found if len(a)]
            if found:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([a for a, _, _, _ in found]).view(np.int64)),
                    pa.array(np.concatenate([np.full(len(a), k, np.int64) for a, _, _, k in found])),
                    pa.array(np.concatenate([s * PLACE + n for _, s, n, _ in found]).astype(np.int64))], schema=schema)


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of the wanted anchors, their windows as bytes of 64-bit hashes."""
    schema = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("tie", pa.int64()), ("start", pa.int32()), ("windows", pa.binary())])
    for batch in batches:
        for part in pieces(batch):
            rows: list[dict] = []
            for i, text, wanted in zip(*(part.column(k).to_pylist() for k in ("id", "text", "wanted"))):
                h = word_hashes(words_of(text))
                keys, first, size = anchors(h)
                windows = gram_hashes(h, WINDOW)
                wanted, tie = set(wanted), text_tie(text)
                for a, s, n in zip(keys.view(np.int64).tolist(), first.tolist(), size.tolist()):
                    if s in wanted:
                        rows.append({"anchor": a, "id": i, "tie": tie, "start": s, "windows": windows[s:s + n].tobytes()})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def parse(fragments: list[tuple[int, int, int, list[int]]]) -> Iterator[tuple[int, int, int, int]]:
    """Factors ``id, tie, start, windows`` of an anchor's fragments, which come in
    the order of places; an index of the block's distinct windows is built on the way."""
    index: dict[int, tuple[int, int]] = {}
    reference: list[list[int]] = []
    last = None
    for *place, windows in fragments:
        if place == last:  # a repeated row
            continue
        last = place
        id_, tie, start = place
        mine = len(reference)
        i, n, new = 0, len(windows), False
        while i < n:
            match = index.get(windows[i])
            if match is None:
                index[windows[i]] = (mine, i)
                new = True
                i += 1
                continue
            # extend along the reference fragment as far as it goes
            text, j = reference[match[0]] if match[0] < mine else windows, match[1]
            k = 1
            while i + k < n and j + k < len(text) and windows[i + k] == text[j + k]:
                k += 1
            yield id_, tie, start + i, k
            i += k  # the windows across the factor's end are looked up next
        reference.append(windows if new else [])


_FACTOR = pa.schema([("id", pa.int64()), ("tie", pa.int64()), ("start", pa.int32()), ("windows", pa.int32())])


def _parse_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int, int, int]] = []

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), _FACTOR.types)], schema=_FACTOR)

    for group in runs(batches, ["anchor"]):
        if len(group) > 1:
            held += parse([(r["id"], r["tie"], r["start"], np.frombuffer(r["windows"], np.uint64).tolist()) for r in group])
        if len(held) >= 1 << 14:
            yield done()
            held = []
    if held:
        yield done()


def _hot_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("anchor", pa.int64()), ("window", pa.int64()), ("id", pa.int64()), ("tie", pa.int64()), ("start", pa.int32())])
    for batch in batches:
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for anchor, i, tie, start, raw in zip(*(batch.column(k).to_pylist() for k in ("anchor", "id", "tie", "start", "windows"))):
            w = np.frombuffer(raw, np.int64)
            for to, x in zip(out, (np.full(len(w), anchor), w, np.full(len(w), i), np.full(len(w), tie), np.arange(start, start + len(w), dtype=np.int32))):
                to.append(x)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], schema=schema)


def order_id(doc_id: Column | str) -> Column:
    return F.coalesce(F.col(doc_id).cast("long") if isinstance(doc_id, str) else doc_id.cast("long"), F.lit(NO_ID))


def place_key(doc_id: Column | str, text: Column | str) -> Column:
    """One value for each id and text: rows that share an id, or have none, are told
    apart by it, so what is gathered by it never exceeds one text's."""
    return F.xxhash64(order_id(doc_id), F.xxhash64(F.coalesce(text, F.lit(""))))


def repeated_spans(docs: DataFrame, hot: int = HOT, dealt: DataFrame | None = None) -> DataFrame:
    """``key, spans, hot, fresh`` of ``key, id, text`` rows: factors as (tie, start,
    windows); places of the fragments of hot anchors, and the windows of these
    that are the first of their kind as (tie, start).

    ``dealt`` are the same rows dealt by ``key``.  Every use of them keeps all their columns,
    so that all read one and the same shuffle.  What is gathered by key is gathered
    as a set: equal rows add nothing to it.
    """
    dealt = docs if dealt is None else dealt
    found = map_batches(docs, _anchor_rows, "anchor long, key long, at long")
    # one shuffle of the anchors: each place learns how often its anchor occurs
    n = F.count(F.lit(1)).over(Window.partitionBy("anchor"))
    again = found.withColumn("n", n).where("n > 1")
    wanted = staged(again.groupBy("key").agg(F.collect_set(F.when(F.col("n") <= hot, F.col("at"))).alias("cold"),
                                             F.collect_set(F.when(F.col("n") > hot, F.col("at"))).alias("hot")), "dedup-places")

    def fragments(places: str) -> DataFrame:
        starts = F.transform(places, lambda at: F.floor(at / PLACE).cast("int"))
        some = wanted.where(F.size(places) > 0).select("key", starts.alias("wanted"))
        return map_batches(dealt.join(some, "key"), _fragments, "anchor long, id long, tie long, start int, windows binary")

    blocks = fragments("cold").repartition("anchor").sortWithinPartitions("anchor", "id", "tie", "start")
    factors = map_batches(blocks, _parse_blocks, "id long, tie long, start int, windows int")
    key = F.xxhash64("id", "tie").alias("key")
    factors = factors.groupBy(key).agg(F.collect_set(F.struct("tie", "start", "windows")).alias("spans"))
    # equal fragments of a hot anchor are folded, then equal windows of the different ones
    place = F.struct("id", "tie", "start")
    firsts = fragments("hot").groupBy("anchor", "windows").agg(F.min(place).alias("first"))
    windows = map_batches(firsts.select("anchor", "first.id", "first.tie", "first.start", "windows"), _hot_windows,
                          "anchor long, window long, id long, tie long, start int")
    first = windows.groupBy("anchor", "window").agg(F.min(place).alias("first")).select("first.*")
    fresh = first.groupBy(key).agg(F.collect_set(F.struct("tie", "start")).alias("fresh"))
    hot_spans = wanted.where(F.size("hot") > 0).select("key", "hot").join(fresh, "key", "left")
    return factors.join(hot_spans, "key", "full")


def own_spans(text: str | None, spans: list[dict] | None, hot: list[int] | None = None, fresh: list[dict] | None = None) -> list[dict]:
    """The spans of this very text, of all that its key has."""
    if not text or not (spans or hot):
        return []
    tie = text_tie(text)
    out = [s for s in spans or () if s["tie"] == tie]
    if hot:
        new = np.array(sorted(f["start"] for f in fresh or () if f["tie"] == tie), np.int64)
        for s in hot:
            # the windows between two firsts are repeats
            a, b = s // PLACE, s // PLACE + s % PLACE
            edges = [a - 1, *new[np.searchsorted(new, a):np.searchsorted(new, b)].tolist(), b]
            out += [{"start": x + 1, "windows": y - x - 1} for x, y in zip(edges, edges[1:]) if y - x > 1]
    return out


def kept_mask(n: int, spans: list[dict]) -> np.ndarray:
    """Which of ``n`` words are outside all spans."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans:
        edge[s["start"]] += 1
        edge[s["start"] + s["windows"] + WINDOW - 1] -= 1
    return np.cumsum(edge[:-1]) == 0


def _digest(rows: dict[str, list]) -> dict[str, list]:
    n_words, n_removed, digests = [], [], []
    for text, *known in zip(rows["text"], rows["spans"], rows["hot"], rows["fresh"]):
        words = words_of(text)
        n_words.append(len(words))
        if spans := own_spans(text, *known):
            words = [w for w, k in zip(words, kept_mask(len(words), spans).tolist()) if k]
        n_removed.append(n_words[-1] - len(words))
        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
    return {"doc_id": rows["doc_id"], "n_words": n_words, "n_removed": n_removed, "kept_sha256": digests}


def cut_text(text: str, spans: list[dict]) -> str:
    """A text without the words in spans, with the blanks of what stays."""
    raw = text.encode("utf-8", "surrogatepass")
    blank = np.isin(np.frombuffer(raw, np.uint8), np.frombuffer(_LINE_BLANKS, np.uint8))
    inside = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)) != 0).reshape(-1, 2)
    kept = kept_mask(len(inside), spans)
    out, at = [], 0
    for (a, b), k in zip(inside.tolist(), kept.tolist()):
        if k:
            out.append(raw[at:b])
        at = b
    if kept.all():
        return text
    return b"".join(out).decode("utf-8", "surrogatepass").strip(" \t\n\x0b\x0c\r")


def dedup_digests(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs``."""
    # dealt by key once: both passes over fragments and the result read this shuffle
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text", order_id("doc_id").alias("id"), place_key("doc_id", "text").alias("key"))
    dealt = rows.repartition(parts, "key")
    spans = repeated_spans(rows, hot, dealt)
    return map_rows(dealt.join(spans, "key", "left").select("doc_id", "text", "spans", "hot", "fresh"), lambda: _digest,
                    "doc_id long, n_words long, n_removed long, kept_sha256 string")


def dedup_documents(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``docs`` with repeated spans cut out of ``text`` and ``n_chars`` set anew;
    documents that nothing is left of go."""
    schema = docs.schema
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.struct(*quoted(docs)).alias("row"), "text", order_id("doc_id").alias("id"), place_key("doc_id", "text").alias("key"))
            .withColumn("row", F.col("row").withField("text", F.lit(None).cast("string"))))
    dealt = rows.repartition(parts, "key")
    spans = repeated_spans(rows.select("text", "id", "key"), hot, dealt)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                texts, *found = (part.column(c).to_pylist() for c in ("text", "spans", "hot", "fresh"))
                new = [cut_text(t, own) if (own := own_spans(t, *known)) else t for t, *known in zip(texts, *found)]
                row = part.column("row")
                columns = {n: row.field(i) for i, n in enumerate(schema.names)}
                columns["text"] = pa.array(new, pa.string())
                if "n_chars" in columns:
                    old = columns["n_chars"]
                    columns["n_chars"] = pa.array([c if a == b else len(b) for a, b, c in zip(texts, new, old.to_pylist())], old.type)
                out = pa.RecordBatch.from_arrays(list(columns.values()), names=schema.names)
                yield out.filter(pa.array([bool(b) or a == b for a, b in zip(texts, new)], pa.bool_()))

    return map_batches(dealt.join(spans, "key", "left").select("row", "text", "spans", "hot", "fresh"), cut, schema)


def op2_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digests(table(spark, sf_dir, "documents"))
