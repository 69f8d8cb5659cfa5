"""Small tables with everything odd in them, and plain versions to compare with."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, as extra columns of the input.
CLASHES = ["id", "key", "h", "host", "row", "size", "spans", "n_words", "component", "bucket", "anchor", "words", "label", "_n", "copies", "target", "line", "a.b", "c`d"]


def odd_rows() -> list[tuple]:
    r = random.Random(4)
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(1, 9)))
    prose = [" ".join(word() for _ in range(n)) for n in (60, 200, 40, 25)]
    passage = " ".join(word() for _ in range(55))
    long = "\n".join(" ".join(word() for _ in range(12)) for _ in range(2500))
    texts = [None, "", "   ", "\n\n", "one two three", prose[0], prose[0], prose[0] + " more", prose[1], passage + " " + prose[2],
             prose[3] + "\n" + passage + "\n" + prose[3], long, "a " * 500, "# * $ % & | < >", "Licensed under CC BY-NC 4.0.\n" + prose[1],
             "ünï cödé 日本語 😀 ▁ x\ty\r\nz", "<|endoftext|> <|startoftext|>mid<|endoftext|>dle </s> <unk>", "  two  spaces  ", "x" * 5000,
             "\x00\x1c\x85  odd blanks", "don't I'LL 123 4.5 İstanbul ǅ ß ﬁ é"]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 3}" if i % 5 else None, len(t) if t else None) for i, t in enumerate(texts)]
    rows += [(None, prose[1], None, None, None), (None, None, None, None, None), (5, prose[0], "en", None, 3), (5, prose[0], "en", None, 3), (5, "other text for the same id " + prose[3], "fr", "s1", 1)]
    return rows


def docs(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(odd_rows() if rows is None else rows, DOC_SCHEMA).repartition(3)


def with_clashes(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES if c not in df.columns])


def words(text: str | None) -> list[bytes]:
    import re

    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def plain_dedup(rows: list[tuple[int | None, str | None]], n: int = 20) -> list[tuple]:
    """(doc_id, words, removed, kept words) by looking at every window."""
    from rowgate.llm.substring_dedup import text_tie

    order = lambda i, t: ((1 << 63) - 1 if i is None else i, text_tie(t))
    first: dict[tuple, tuple] = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - n + 1):
            x = tuple(w[k:k + n])
            first[x] = min(first.get(x, (order(i, t), k)), (order(i, t), k))
    out = []
    for i, t in rows:
        w = words(t)
        keep = [True] * len(w)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < (order(i, t), k):
                keep[k:k + n] = [False] * n
        kept = [x for x, y in zip(w, keep) if y]
        out.append((i, len(w), len(w) - len(kept), kept))
    return out


def plain_classes(rows: list[tuple[int | None, str | None]], threshold: float = 0.8) -> dict[str, tuple]:
    """By text: smallest id of its class, links, copies, and a name of the class."""
    ids: dict[str, list] = {}
    for i, t in rows:
        ids.setdefault(t or "", []).append(i)
    texts = list(ids)
    sets = []
    for t in texts:
        w = words(t)
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    up = list(range(len(texts)))

    def root(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    links = [0] * len(texts)
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    least: dict[int, int] = {}
    for i, t in enumerate(texts):
        own = [x for x in ids[t] if x is not None]
        if own:
            least[root(i)] = min(own + ([least[root(i)]] if root(i) in least else []))
    return {t: (least.get(root(i)), links[i], len(ids[t]), root(i)) for i, t in enumerate(texts) if sets[i]}
