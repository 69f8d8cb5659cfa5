"""Every operator on odd and empty tables, and against plain versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from itertools import product

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rowgate.llm import line_frequency, license_scan, mixing, ngram_join, permutation_index, sentencepiece_bpe, substring_dedup, token_counts, token_files, toxicity
from rowgate.session import fresh_dir
from tests.llm.helpers import SF, docs, odd_rows, plain_classes, plain_dedup, with_clashes, words


@pytest.fixture(scope="module")
def odd(spark):
    return with_clashes(docs(spark))


@pytest.fixture(scope="module")
def none(spark):
    return with_clashes(docs(spark, []))


@pytest.fixture(scope="module")
def small():
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text", "source"]).to_pylist()
    return sorted(t, key=lambda r: r["doc_id"])


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# 1 line frequency

def plain_repeats(w):
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    return len({k + d for p in seen.values() if len(p) > 1 for k in p for d in range(5)})


def test_text_rules():
    for _, text, *_ in odd_rows():
        w = words(text)
        lines = [x for x in (text or "").split("\n") if words(x)]
        want = (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), plain_repeats(w))
        assert line_frequency.text_rules(text) == want


def test_line_frequency(spark, odd, none):
    got = line_frequency.line_frequency(odd).collect()
    assert len(got) == len(odd_rows())
    assert all(r.base_failed for r in got if r.n_words < 10) and not any(r.kept for r in got if r.base_failed)
    assert line_frequency.line_frequency(none).count() == 0
    # 30 documents of a host share a line; most of them have little else
    shared = "this very line stands in all documents of this host"
    rows = [(i, f"{shared} 7{i}\nown words " + " ".join(f"w{i}x{k}" for k in range(3 if i % 3 else 60)), "en", "h", 0) for i in range(30)]
    rows += [(100 + i, rows[0][1], "en", "h", 0) for i in range(500)]  # copies don't count
    rows += [(1000 + i, f"{shared} 0\n" + " ".join(f"v{i}x{k}" for k in range(30)), "en", None, 0) for i in range(5)]
    got = {r.doc_id: r for r in line_frequency.line_frequency(docs(spark, rows)).collect()}
    for i, t, _, s, _ in rows:
        assert got[i].n_removed_lines == 0  # numbers of one digit or two are different lines
    rows = [(i, t.replace(f" 7{i}\n", " 7\n"), a, s, n) for i, t, a, s, n in rows]
    got = {r.doc_id: r for r in line_frequency.line_frequency(docs(spark, rows)).collect()}
    for i, t, _, s, _ in rows:
        assert got[i].n_removed_lines == (1 if s == "h" and i < 100 else 0)
        assert got[i].kept == (i >= 100 or i % 3 == 0)


# 2 substring dedup

@pytest.mark.parametrize("hot", [5000, 2])
def test_dedup_against_windows(spark, odd, hot):
    got = substring_dedup.dedup_digests(odd, hot).collect()
    want = plain_dedup([(r[0], r[1]) for r in odd_rows()])
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(((i, n, k, hashlib.sha256(b" ".join(x)).hexdigest()) for i, n, k, x in want), key=key)


def test_dedup_small_and_empty(spark, small, none):
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.op2_rlz_dedup(spark, SF).collect()}
    want = plain_dedup([(r["doc_id"], r["text"]) for r in small])
    assert got == {i: (n, k, hashlib.sha256(b" ".join(x)).hexdigest()) for i, n, k, x in want}
    assert sum(k for _, _, k, _ in want) > 0
    assert substring_dedup.dedup_digests(none).count() == 0


def test_rows_without_id_are_gathered_by_text(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(None if i % 3 else 7, f"own{i} {passage} {'x' * i} end{i} " + " ".join(f"w{i}v{k}" for k in range(20)), "en", "s", 0) for i in range(60)]
    rows += rows[1:2] * 40 + rows[3:4] * 40  # rows equal in both
    table = docs(spark, rows)
    keyed = table.select("text", substring_dedup.order_id("doc_id").alias("id"), substring_dedup.place_key("doc_id", "text").alias("key"))
    assert all(r.h == substring_dedup.text_tie(r.text) for r in table.select("text", F.xxhash64("text").alias("h")).collect())
    for hot in (5000, 2):
        spans = [r.spans or r.fresh or [] for r in substring_dedup.repeated_spans(keyed, hot).collect()]
        assert len(spans) in (59, 60) and all(len({s.tie for s in x}) <= 1 and len(set(x)) == len(x) <= (41 if hot == 5000 else 64) for x in spans)
        want = plain_dedup([(r[0], r[1]) for r in rows])
        got = substring_dedup.dedup_digests(table, hot).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(str((i, n, k, hashlib.sha256(b" ".join(x)).hexdigest())) for i, n, k, x in want)


def test_anchors_depend_on_the_window_only():
    r = np.random.RandomState(0)
    h = r.randint(0, 1 << 62, 300).astype(np.uint64)
    own = {}
    for a, s, n in zip(*(x.tolist() for x in substring_dedup.anchors(h))):
        for k in range(s, s + n):
            own[k] = a
    assert sorted(own) == list(range(281))
    for k in (0, 17, 100, 280):
        assert substring_dedup.anchors(h[k:k + 20])[0].tolist() == [own[k]]


def test_cut_text_keeps_the_rest():
    text = "\n".join(f"a{i} b{i}" for i in range(40)) + "\n"
    assert substring_dedup.cut_text(text, []) == text
    got = substring_dedup.cut_text(text, [{"start": 4, "windows": 3}])
    assert got.split() == text.split()[:4] + text.split()[26:] and got.startswith("a0 b0\na1 b1\na13")


# 3 permutation index

def test_permutation_index(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet")
    ids, x = np.array(t["vec_id"].to_pylist()), np.array(t["embedding"].to_pylist(), float)
    hits = n = 0
    for sf_rows in [permutation_index.op3_permutation_index(spark, SF).collect()]:
        by = {}
        for r in sf_rows:
            by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        for q in ids[ids % 50 == 0].tolist():
            i = int(np.flatnonzero(ids == q)[0])
            s = (x * x[i]).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((x[i] * x[i]).sum()))
            best = sorted((-c, v) for c, v in zip(s.tolist(), ids.tolist()) if v != q)[:5]
            hits += len({v for _, v in best} & {v for _, v, _ in by[q]})
            n += len(best)
            assert [k for k, _, _ in sorted(by[q])] == [1, 2, 3, 4, 5]
            assert all(abs(s[ids == v][0] - c) < 1e-12 for _, v, c in by[q])
    assert hits / n >= 0.9


def test_permutation_index_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (100, None), (150, [0.0, 0.0]), (200, [nan, 1.0]), (250, [inf, 1.0]), (300, [None, 1.0]),
            (None, [1.0, 1.0]), (7, [3.0, 0.0]), (3, [2.0, 0.0]), (3, [2.0, 0.0]), (9, [1.0, 1.0]), (11, [-1.0, 0.0]),
            (350, [1.0, 0.0, 0.0]), (12, [1.0]), (400, [])]  # of another length than most
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("*", F.lit(1).alias("block"), F.lit(1).alias("score"))
    q = v.where("vec_id % 50 = 0")
    for block in (8192, 3):
        got = sorted(map(tuple, permutation_index.search(v, q, block=block, chunk=1).collect()))
        assert [g[:3] for g in got] == [(0, 1, 3), (0, 2, 7), (0, 3, 9), (0, 4, 50), (0, 5, 11), (50, 1, 9), (50, 2, 0), (50, 3, 3), (50, 4, 7), (50, 5, 11)]
    assert permutation_index.search(v.limit(0), q.limit(0)).count() == 0


# 4 toxicity

def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs_, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.op4_toxicity_mil(spark, d).collect()}
    assert len(got) == docs_.count()
    held = [(got[r.doc_id], r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    assert all(x.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, x in got.items())
    toxic, clean = [x for x, y in held if y], [x for x, y in held if not y]
    assert sum(x.predicted for x in toxic) >= 0.7 * len(toxic) and sum(x.predicted for x in clean) <= 0.02 * len(clean)
    texts = dict(docs_.select("doc_id", "text").collect())
    assert any("idiot" in texts[x.doc_id][s.start:s.end] for x in toxic for s in x.spans)


def test_toxicity_odd(spark, odd, none):
    model = toxicity.fit(["you idiot here. fine words"] * 4 + ["fine words here. you too"] * 6, [1] * 4 + [0] * 6)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(none, model).count() == 0
    assert toxicity.clean_documents(odd, model).columns == odd.columns
    labels = spark.createDataFrame([(None, 1), (5, None), (99, 1)], "doc_id long, toxic int")
    empty = toxicity.train(odd, labels)
    assert empty.weights == {} and {r.score for r in toxicity.score(odd, empty).collect()} == {0.0}
    assert model.scorer()("an idiot speaks. fine words")[1] == [(0, 15)]


# 5 mixing

def plain_targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(most * sizes[s] for s in stopped)
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free} | {s: most * sizes[s] for s in stopped}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target
        stopped |= above


def test_mix(spark, odd, none):
    for rows, df in ((odd_rows(), odd), (None, read(spark, "documents"))):
        got = mixing.mix(df).collect()
        if rows is None:
            rows = [(r.doc_id, r.text, None, r.source, None) for r in df.collect()]
        assert len(got) == len(rows)
        sizes = {}
        for _, t, _, s, _ in rows:
            sizes[s] = sizes.get(s, 0) + len(words(t))
        target = plain_targets(sizes)
        assert sorted((str(r.doc_id), str(r.source), r["size"]) for r in got) == sorted((str(i), str(s), len(words(t))) for i, t, _, s, _ in rows)
        taken, largest = {}, {}
        for r in got:
            assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source] and 0 <= r.copies <= 2
            taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
        for s in sizes:
            least = max([r["size"] for r in got if r.source == s])
            assert taken[s] <= target[s] + 1e-6 and target[s] - taken[s] < least
        again = mixing.mix(df).collect()
        assert sorted(map(str, got)) == sorted(map(str, again))
        whole = mixing.mixed_documents(df)
        assert whole.columns == df.columns and whole.count() == sum(r.copies for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


@pytest.mark.parametrize("share", [0.3, 1.6])
def test_inclusion_probabilities(spark, share):
    """Over many draws - sources that are made alike - short and long documents come as
    often as their probability says."""
    sizes = [5] * 15 + [60] * 15 + [400] * 15
    rows = [(n * 1000 + i, " ".join(["w"] * (k - 1)) + f" n{i}", "en", f"s{n:03}", 0) for n in range(150) for i, k in enumerate(sizes)]
    got = {}
    for r in mixing.mix(docs(spark, rows), share=share, weights=(1.0,)).collect():
        a = got.setdefault(r["size"], [0, 0])
        a[0] += r.copies - int(share)
        a[1] += 1
        assert r.p == pytest.approx(got.setdefault(("p", r["size"]), r.p))
    p = {k: got["p", k] for k in (5, 60, 400)}
    assert 1 >= p[5] > 1.5 * p[400] > 0 and p[5] >= p[60] > p[400]
    assert 15 * sum(k * x for k, x in p.items()) == pytest.approx((share - int(share)) * 15 * sum(p))  # the words of the rest
    for k, x in p.items():
        taken, n = got[k]
        error = 4 * (x * (1 - x) / n) ** 0.5 + 1 / 15  # and one document more or less in each group
        assert abs(taken / n - x) <= error, (k, taken / n, x)


# 6 n-gram join

def near_copies():
    import random

    r = random.Random(8)
    rows = [(i, t, None, None, None) for i, t, *_ in odd_rows()]
    base = [f"w{r.randint(0, 10**6)}" for _ in range(150)]
    for k in range(24):
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = f"z{r.randint(0, 10**6)}"
        rows.append((100 + k, " ".join(w), None, None, None))
    return rows


def test_near_duplicates(spark, none, monkeypatch):
    rows = near_copies()
    want = plain_classes([(r[0], r[1]) for r in rows])
    for blocks in ((512, 128), (4, 3)):  # large groups in many pairs of blocks
        monkeypatch.setattr(ngram_join.candidate_links, "__defaults__", (ngram_join.TREES, blocks[0]))
        monkeypatch.setattr(ngram_join.verified_links, "__defaults__", (blocks[1],))
        got = ngram_join.near_duplicates(with_clashes(docs(spark, rows))).collect()
        keys = {hashlib.md5((t or "").encode()).digest(): t or "" for _, t, *_ in rows}
        assert len(got) == len(rows)
        for r in got:
            text = keys[bytes(r.text_key)]
            if text in want:
                assert (r.class_id, r.n_links, r.n_copies) == want[text][:3]
            else:
                assert r.class_id == r.doc_id and r.n_links == 0
    assert any(v[1] > 1 for v in want.values())
    assert ngram_join.near_duplicates(none).count() == 0


def test_first_of_each_class(spark):
    rows = near_copies()
    want = plain_classes([(r[0], r[1]) for r in rows])
    got = ngram_join.first_of_each_class(with_clashes(docs(spark, rows))).collect()
    wordless = [r for r in rows if (r[1] or "") not in want]
    kept = [(r.doc_id, r.text) for r in got if (r.text or "") in want]
    assert len(got) - len(kept) == len(wordless)
    assert sorted(want[t][3] for _, t in kept) == sorted({v[3] for v in want.values()}) and all(i == want[t][0] for i, t in kept)


def test_forest_recall_and_depth():
    assert ngram_join.stop_depth(0.8, 32, 0.9999) == 6 and 1 - (1 - 0.8**6) ** 32 >= 0.9999 > 1 - (1 - 0.8**7) ** 32
    r = np.random.RandomState(3)
    a = r.randint(0, 1 << 62, 400).astype(np.uint64)
    est = []
    for _ in range(40):
        b = np.append(a[:340], r.randint(0, 1 << 62, 40).astype(np.uint64))
        s = ngram_join.signatures([np.unique(a), np.unique(b)])
        est.append((s[0] == s[1]).mean())
    assert abs(np.mean(est) - (340 / 440 + 100 / 440 / 256)) < 0.02


# 7, 8, 10 tokens

def want_tokens():
    import public_tokenizers as p
    from tokenizers import Tokenizer

    return Tokenizer.from_file(p.path(token_counts.TOKENIZER))


@pytest.mark.parametrize("size,cache", [(1 << 16, 200_000), (4, 3)])
def test_token_counts(spark, odd, none, size, cache):
    tok = want_tokens()
    got = token_counts.count_tokens(odd, size=size, cache=cache).collect()
    want = []
    for i, t, *_ in odd_rows():
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    if size > 4:
        assert token_counts.count_tokens(none).count() == 0


def test_lengths_table():
    w = [f"w{i}".encode() for i in range(5000)]
    t = token_counts.Lengths(w, [i % 300 for i in range(5000)])
    h = token_counts.word_hashes(w + [b"missing", b"too"])
    n, missing = t.find(h)
    assert n[:5000].tolist() == [i % 300 for i in range(5000)] and sorted(missing.tolist()) == [5000, 5001]


def test_sentencepiece(spark, odd, none, small):
    import public_tokenizers as p
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=p.path(sentencepiece_bpe.MODEL))
    got = sentencepiece_bpe.encode_decode(odd, ids_out=True).collect()
    want = []
    for i, t, *_ in odd_rows():
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest(), ids, sp.decode(ids)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sentencepiece_bpe.encode_decode(none).count() == 0
    codec = sentencepiece_bpe.Codec(open(p.path(sentencepiece_bpe.MODEL), "rb").read(), cache=50)
    for r in small[:60]:
        assert codec.encode(r["text"]).tolist() == sp.encode(r["text"], add_bos=True, add_eos=True)


def test_backtracking_is_merging():
    import random

    import public_tokenizers as p

    pieces = sentencepiece_bpe.Pieces(open(p.path(sentencepiece_bpe.MODEL), "rb").read())
    r = random.Random(5)
    names = [x for x in pieces.ids if len(x) < 7]
    for _ in range(1500):
        text = "".join(r.choice(names) for _ in range(r.randint(1, 6))).replace("▁", "")
        if text and pieces.known.issuperset(text):
            assert [pieces.text[i] for i in pieces.backtracked(text)] == pieces.merged(text)


def want_files(rows):
    import public_tokenizers as p
    from tokenizers import Tokenizer

    tok, at, out = Tokenizer.from_file(p.path(token_files.TOKENIZER)), 0, []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files(spark, odd, none, small):
    got = token_files.op10_token_files(spark, SF).collect()
    assert sorted(map(tuple, got)) == want_files([(r["doc_id"], r["text"]) for r in small])
    path = fresh_dir(spark, "test-files")
    token_files.write_token_files(odd, path, block=50)
    got = sorted(map(tuple, token_files.read_token_files(spark, path).collect()), key=lambda r: r[1])
    want = {(str(i), n, c) for i, _, n, c in want_files([(r[0], r[1]) for r in odd_rows()])}
    assert {(str(i), n, c) for i, _, n, c in got} == want and len(got) == len(odd_rows())
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda i: -1 if i is None else i)
    path = fresh_dir(spark, "test-files")
    token_files.write_token_files(none, path)
    assert token_files.read_token_files(spark, path).count() == 0


def test_blocks_round_trip():
    r = np.random.RandomState(1)
    for sizes in ([], [0], [1], [5, 0, 3], [1000, 1, 77]):
        own = [(r.randint(0, 1 << 31, n).astype(np.uint32) >> r.randint(0, 31, n).astype(np.uint32)) for n in sizes]
        back = token_files.decode_block(token_files.encode_block(own))
        assert [x.tolist() for x in back] == [x.tolist() for x in own]
    whole = token_files.encode_block([np.arange(300, dtype=np.uint32)])
    with pytest.raises(ValueError):
        token_files.decode_block(whole[:-1])


def test_cut_encoder_is_the_tokenizer():
    import public_tokenizers as p

    model = open(p.path(token_files.TOKENIZER), "rb").read()
    for bits, texts in product((4, 12), ([t or "" for _, t, *_ in odd_rows()], ["a\nb c", "a\n\nb", " lead", "trail ", "tab\tx y", "x\n y", "nb sp a", "a<|endoftext|> b"])):
        e = token_files.Encoder(model, bits)
        want = [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, e.type).tobytes() for t in texts]
        assert e.encode(texts) == want and e.encode(texts) == want


# 9 licences

def test_license_scan(spark, odd, none, small):
    got = license_scan.scan_licenses(odd).collect()
    assert len(got) == len(odd_rows()) and [r.licenses for r in got if r.n_notices] == ["cc-by-nc-4.0"]
    assert license_scan.scan_licenses(none).count() == 0
    wording = {"apache-2.0": "licensed under the apache license, version 2.0", "mit": "released under the mit license",
               "gpl-3.0": "licensed under the gnu general public license, version 3", "cc-by-nc-4.0": "licensed under cc by-nc 4.0", "all-rights-reserved": "all rights reserved"}
    found = {r.doc_id: r.licenses for r in license_scan.op9_license_scan(spark, SF).collect()}
    for r in small:
        assert found[r["doc_id"]] == ",".join(sorted(k for k, v in wording.items() if v in r["text"].lower()))


def test_wording_decides():
    scan = license_scan.Scanner().scan
    names = lambda t: [x["license"] for x in scan(t)[1]]
    assert names("Licensed under CC BY-NC-SA 4.0.") == ["cc-by-nc-sa-4.0"]
    assert names("Licensed under CC BY 4.0. Then, released under the MIT License.") == ["cc-by-4.0", "mit"]
    assert names("Licensed under the GNU Lesser General Public License, version 3") == ["lgpl-3.0"]
    assert names("a licence to print money") == []
    far = "word " * 5000 + "All rights reserved." + " word" * 5000
    assert [(x["start"], x["license"]) for x in scan(far)[1]] == [(25000, "all-rights-reserved")]
    assert len(scan("All rights reserved. " * 400)[1]) == 400


def test_all_notices_of_a_block():
    names = lambda t: [x["license"] for x in license_scan.Scanner().scan(t)[1]]
    some = {"mit": "Licensed under the MIT License.", "bsd": "Licensed under the BSD License.", "apache-2.0": "Licensed under the Apache License, Version 2.0.",
            "mpl-2.0": "Licensed under the Mozilla Public License, version 2.0.", "lgpl-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
            "cc-by-4.0": "Licensed under CC BY 4.0.", "all-rights-reserved": "All rights reserved."}
    assert names(" ".join(some.values())) == list(some)
    short: dict[str, str] = {}
    for name, _, wording in license_scan.TEMPLATES:
        short.setdefault(name, wording)
    for order in (list(short), list(short)[::-1]):
        assert names(".\n".join(short[n] for n in order)) == order


@pytest.mark.parametrize("gap", ["\n", "  ", "\n# ", "\n * ", "\r\n\r\n// "])
def test_wrapped_notices(gap):
    scan = license_scan.Scanner().scan
    for name, _, wording in license_scan.TEMPLATES:
        own = gap.join(wording.split())
        (hit,) = scan("\u0130 word " * 400 + own + gap + "word " * 400)[1]
        assert (hit["license"], hit["start"], hit["missing"], hit["inserted"]) == (name, 2800, [], [])
        assert own.startswith(("\u0130 word " * 400 + own)[2800:hit["end"]]) and hit["end"] >= 2800 + len(own) - 1


def test_notices_across_blocks():
    scan = license_scan.Scanner().scan
    for name, wording in (("apache-2.0", license_scan.TEMPLATES[1][2]), ("mit", license_scan.TEMPLATES[4][2])):
        for n in range(license_scan.SPAN - 60, license_scan.SPAN + 60):
            (hit,) = scan("license " + "word license " * (n // 2) + "word. " * (n % 2) + wording)[1]
            assert (hit["license"], hit["missing"]) == (name, [])


def test_compression_decides(monkeypatch):
    """Without reductions nothing is found, and with another ranking another wording wins."""
    seven = ("Licensed under the MIT License. Licensed under the BSD License. Licensed under the Apache License, Version 2.0. "
             "Licensed under the Mozilla Public License, version 2.0. Licensed under the GNU Lesser General Public License, version 2.1. "
             "Licensed under CC BY 4.0. All rights reserved.")
    long = license_scan.TEMPLATES[1][2]
    scan = license_scan.Scanner().scan
    names = [x["license"] for x in scan(seven)[1]]
    assert names == ["mit", "bsd", "apache-2.0", "mpl-2.0", "lgpl-2.1", "cc-by-4.0", "all-rights-reserved"]
    (hit,) = scan(long)[1]
    assert hit["missing"] == [] and hit["end"] == len(long)
    true = license_scan.Scanner.reductions
    monkeypatch.setattr(license_scan.Scanner, "reductions", lambda self, words: [0] * len(self.templates))
    assert scan(seven)[1] == [] and scan(long)[1] == []
    monkeypatch.setattr(license_scan.Scanner, "reductions", lambda self, words: [100 - x if x >= license_scan.LEAST_SAVED else 0 for x in true(self, words)])
    assert scan(long)[1] != [hit]  # the shorter wording stands first


# whole tables against the libraries and plain code

def test_token_counts_of_the_whole_table(spark, small):
    import public_tokenizers as tokenizers_files
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizers_files.path("word_bpe_49k.json"))
    want = {r["doc_id"]: (len((r["text"] or "").encode()), len(tok.encode(r["text"] or "", add_special_tokens=False).ids)) for r in small}
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.op7_token_counts(spark, SF).collect()}
    assert got == want


def test_sentencepiece_of_the_whole_table(spark, small):
    import public_tokenizers as tokenizers_files
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizers_files.path("piece_bpe_32k.model"))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentencepiece_bpe.op8_sentencepiece(spark, SF).collect()}
    for r in small:
        ids = sp.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert got[r["doc_id"]] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())


def test_scores_against_a_plain_noisy_or(spark, odd):
    """The score of every document from its sentences, one by one."""
    import math

    model = toxicity.fit(["you idiot here. fine words"] * 4 + ["fine words here. you too"] * 6, [1] * 4 + [0] * 6)

    def plain(text):
        clean, faint = 1.0, 1.0
        for sentence in re.split(r"[.!?\n]+", text or ""):
            if sentence and model.weights:
                found = {f for w in sentence.split() for f in toxicity.features(w)}
                p = 1 / (1 + math.exp(-model.bias - sum(model.weights.get(f, 0.0) for f in found)))
                clean, faint = (clean, faint * (1 - p)) if p < toxicity.FAINT else (clean * (1 - p), faint)
        return 1 - clean * max(faint, 1 - toxicity.FAINT_SUM)

    rows = docs(spark, [(i, t, None, None, None) for i, t in enumerate(["an idiot speaks. fine words", "you idiot! you too", "fine\nfine", None, "...", "a. b. c"])])
    for r in toxicity.score(rows, model).collect():
        text = rows.where(F.col("doc_id") == r.doc_id).first().text
        assert r.score == pytest.approx(plain(text), abs=1e-9)


def test_length_alone_is_not_toxic():
    model = toxicity.fit(["you idiot here. fine words"] * 4 + ["fine words here. you too"] * 6, [1] * 4 + [0] * 6)
    score = model.scorer()
    clean = "fine words here. you too. "
    assert score(clean * 20_000)[0] <= toxicity.FAINT_SUM + 1e-9 and score(clean * 20_000)[1] == []
    one = score(clean * 5000 + "you idiot here. " + clean * 5000)
    assert one[0] >= toxicity.THRESHOLD and one[1]
