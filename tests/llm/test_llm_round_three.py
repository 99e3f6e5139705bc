"""Fingerprints, fill-in-the-middle and hard negatives against plain loops."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeleads.llm import (
    fill_in_middle,
    fingerprints,
    hard_negatives,
    page_wrapper,
    sentencepiece_nbest,
)
from placeleads.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


# Fingerprints


def winnow(text):
    """Selected hashes and positions, window by window."""
    units = re.findall("[^\\x20\\x09-\\x0D⺀-\U0010ffff]{1,8}|[⺀-\U0010ffff]", text or "")
    codes = [zlib.crc32(u.encode()) % (fingerprints.PRIME - 1) + 1 for u in units]
    if not codes:
        return []
    codes += [0] * (fingerprints.GRAM - len(codes))

    def rolled(base):
        out = []
        for i in range(len(codes) - fingerprints.GRAM + 1):
            value = 0
            for c in codes[i : i + fingerprints.GRAM]:
                value = (value * base + c) % fingerprints.PRIME
            out.append(value)
        return out

    first, second = rolled(fingerprints.BASE), rolled(fingerprints.SECOND_BASE)
    width, chosen = min(fingerprints.WINDOW, len(first)), []
    for start in range(len(first) - width + 1):
        at = min(range(start, start + width), key=lambda i: (first[i], -i))
        if at not in chosen:
            chosen.append(at)
    return [(first[i] * (1 << 31) + second[i], i) for i in chosen]


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))


def some_texts(count, seed):
    rng = random.Random(seed)
    words = ["a", "b", "the", "x" * 30, "漢字かな", "é", "🙂z", "word"]
    return [rng.choice([" ", "\n", "\t "]).join(rng.choices(words, k=rng.randrange(0, 40))) for _ in range(count)]


def test_fingerprints_are_the_rightmost_minima_of_all_windows(spark):
    texts = [None, "", " \n", "one", "one two three", "a " * 500, "z" * 10_000, *some_texts(60, 1)]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "i int, text string, N_chars string")
    done = fingerprints.add_fingerprints(df)
    assert done.columns == ["i", "text", "n_chars", "fingerprint"]
    for r in done.collect():
        assert [(e["hash"], e["position"]) for e in r["fingerprint"]] == winnow(texts[r["i"]])
        assert r["n_chars"] == len(texts[r["i"]] or "")


def test_a_shared_passage_shares_a_fingerprint(spark):
    rng = random.Random(3)
    rows = []
    for i in range(40):
        passage = [f"p{i}_{j}" for j in range(fingerprints.GRAM + fingerprints.WINDOW - 1)]
        for _ in range(2):
            around = [[f"w{rng.randrange(10**9)}" for _ in range(rng.randrange(12))] for _ in range(2)]
            rows.append((i, " ".join([*around[0], *passage, *around[1]])))
    df = fingerprints.add_fingerprints(spark.createDataFrame(rows, "i int, text string"))
    both = df.groupBy("i").agg(F.collect_list(fingerprints.hashes(F.col("fingerprint"))).alias("h"))
    assert both.select(F.size(F.array_intersect(F.get("h", F.lit(0)), F.get("h", F.lit(1)))).alias("n")).where("n = 0").count() == 0


@pytest.mark.parametrize("count", [1, 2, 256, 700])
def test_each_document_meets_the_next_one(spark, count):
    ids = random.Random(count).sample(range(-5000, 5000), count)
    texts = dict(zip(sorted(ids), some_texts(count, count), strict=True))
    rows = spark.createDataFrame([(i, texts[i]) for i in ids], "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r for r in fingerprints.compare_edited(rows).collect()}
    order = sorted(ids)
    for i, doc in enumerate(order):
        text, following = texts[doc], texts[order[(i + 1) % count]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (got[doc]["text"], got[doc]["edited"]) == (text, edited)
        assert got[doc]["near_edited"] == alike(winnow(text), winnow(edited))
        assert got[doc]["near_next"] == alike(winnow(text), winnow(following))


def test_repeated_rows_and_missing_values_have_a_next_document(spark):
    rows = [(1, "a b c d")] * 300 + [(1, "other text here"), (2, None), (None, "no id"), (None, None), (3, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, copies string")
    done = fingerprints.compare_edited(df)
    assert done.count() == len(rows)
    assert done.distinct().count() == 6
    assert done.where("text = ''").where("near_edited <> 1").count() == 0
    empty = fingerprints.compare_edited(df.limit(0))
    assert empty.count() == 0 and empty.schema == done.schema


def test_fingerprints_need_no_python(spark, plan_of):
    plan = plan_of(LLM_QUERIES["op11_fingerprints"](spark, SF))
    assert "Arrow" not in plan and "Python" not in plan and "Pandas" not in plan


# Fill-in-the-middle


def starts(text, unit):
    data = text.encode()
    blank = b" \t\n\v\f\r"
    if unit == "char":
        found = [i for i in range(len(data)) if data[i] & 0xC0 != 0x80]
    elif unit == "line":
        found = [i for i in range(len(data)) if not i or data[i - 1 : i] == b"\n"]
    else:
        found = [i for i in range(len(data)) if not i or (data[i] not in blank and data[i - 1] in blank)]
    return [*found, len(data)]


@pytest.mark.parametrize("unit", ["char", "line", "word"])
def test_boundary_sets_select_every_rank(unit):
    rng = random.Random(5)
    pieces = ["a", "漢字", "é", "🙂", " ", "\n", "word ", "x" * 300]
    texts = ["", "a", "é漢é", "\n", "a" * 65_535, "a" * 65_536, "é" * 32_768, "漢" * 50_000, "a" * 70_000 + "漢" * 9]
    texts += ["".join(rng.choices(pieces, k=rng.randrange(3000))) for _ in range(6)]
    texts += ["".join(rng.choices("aé", k=90_000)), "a\n" * 40_000]
    kinds = set()
    for text in texts:
        bounds, expected = fill_in_middle.BoundarySet(text.encode(), unit), starts(text, unit)
        assert len(bounds) == len(expected) and bounds.units == len(expected) - 1
        ranks = range(len(expected)) if len(expected) < 3000 else rng.sample(range(len(expected)), 2000)
        assert all(bounds.select(r) == expected[r] for r in [*ranks, 0, len(expected) - 1])
        kinds |= {c[0] for c in bounds.containers}
    assert kinds == {"run", "array", "bitmap"}


def test_outputs_give_the_text_back(spark):
    texts = ["", None, "a", "<P", "x <S> y", "<<P>", "é漢🙂" * 50, "line\nline\n", "S>", "word " * 30_000]
    rows = [(i, texts[i % len(texts)], "c") for i in range(300)] + [(None, "no id", "c"), (5, "same", "c"), (5, "same", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, OUTPUT string")
    for unit in ("char", "line", "word"):
        done = fill_in_middle.restore(fill_in_middle.transform(df, unit=unit))
        assert len({c.lower() for c in done.columns}) == len(done.columns)
        got = done.collect()
        assert len(got) == len(rows)
        assert all(r["restored"] == (r["text"] or "") for r in got)
        assert {r["form"] for r in got} == {"plain", "psm", "spm"}
        for r in got:
            marked = any(m in (r["text"] or "") for m in ("<P>", "<S>", "<M>"))
            assert r["n"] == len(starts(r["text"] or "", unit)) - 1
            if not r["text"] or marked:
                assert r["form"] == "plain" and r["output"] == (r["text"] or "") and r["prefix_units"] is None
            elif r["form"] != "plain":
                data, a = r["text"].encode(), r["prefix_bytes"]
                b = a + r["middle_bytes"]
                assert (a, b) == tuple(starts(r["text"], unit)[k] for k in (r["prefix_units"], r["prefix_units"] + r["middle_units"]))
                parts = [p.decode() for p in (data[:a], data[a:b], data[b:])]
                orders = {"psm": "<P>{0}<S>{2}<M>{1}", "spm": "<S>{2}<P>{0}<M>{1}"}
                assert r["output"] == orders[r["form"]].format(*parts)
    empty = fill_in_middle.transform(df.limit(0))
    assert empty.count() == 0 and empty.schema == fill_in_middle.transform(df).schema


# Hard negatives


def mined(rows):
    """All rows of the result, from every pair of rows."""
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * x) for x in v]
        if all(abs(x) < hard_negatives.LIMIT for x in whole):
            key = (label, np.array(whole, "<i4").tobytes())
            if i not in best or key < best[i][0]:
                best[i] = (key, whole, label)
    out = []
    for a, (_, v, label) in best.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, m) for i, (_, w, m) in best.items() if i != a)
        for minus, p, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and -30 * minus <= -100 * s[0] <= -90 * minus]
            out += [(a, p, k, n, -minus, -s) for k, (s, n, _) in enumerate(inside[:10], 1)]
    return sorted(out)


def random_vectors(count, seed, dims=6, coarse=False):
    rng = random.Random(seed)
    step = 0.25 if coarse else 1e-6
    return [
        (i, [round(rng.uniform(-1, 1) / step) * step for _ in range(dims)], rng.randrange(3))
        for i in rng.sample(range(-400, 4 * count), count)
    ]


def vectors(spark, rows, parts=5):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(parts)


@pytest.mark.parametrize("coarse", [False, True])
def test_negatives_equal_those_of_all_pairs(spark, monkeypatch, coarse):
    rows = random_vectors(500, 1 + coarse, coarse=coarse)
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    expected = mined(rows)
    assert len(expected) >= 100
    got = hard_negatives.mine(vectors(spark, rows))
    assert sorted(map(tuple, got.collect())) == expected
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 3000)  # several blocks of anchors
    got = hard_negatives.mine(vectors(spark, rows, 1))
    assert sorted(map(tuple, got.collect())) == expected


def test_odd_vectors_take_no_part_or_count_once(spark):
    rows = random_vectors(150, 9)
    rows += [rows[0]] * 5 + [(rows[1][0], [0.5] * 6, 0), (rows[1][0], [0.5] * 6, 1)]
    rows += [(None, [1.0] * 6, 1), (9000, None, 1), (9001, [1.0] * 6, None), (9002, [], 1), (9100, [0.1, 0.2], 2)]
    rows += [(9003, [None] + [1.0] * 5, 1), (9004, [math.inf] * 6, 1), (9005, [math.nan] * 6, 1)]
    rows += [(9006, [1e30] * 6, 1), (9007, [0.3] * 9, 0), (9200, [-0.4] * 9, 1)]
    expected = mined(rows)
    df = vectors(spark, rows).withColumn("score", F.lit("clash")).withColumn("rank", F.lit(0))
    got = hard_negatives.mine(df)
    assert sorted(map(tuple, got.collect())) == expected
    empty = hard_negatives.mine(df.limit(0))
    assert empty.count() == 0 and empty.columns == got.columns
    no_anchor = hard_negatives.mine(df.where("vec_id % 100 <> 0"))
    assert no_anchor.count() == 0 and no_anchor.schema == got.schema


def test_a_hot_label_and_equal_vectors_keep_all_windows(spark):
    rows = random_vectors(200, 4) + [(10_000 + i, [0.5] * 6, 1) for i in range(300)]
    got = hard_negatives.mine(vectors(spark, rows))
    assert sorted(map(tuple, got.collect())) == mined(rows)


def test_large_components_are_multiplied_exactly():
    rng = np.random.default_rng(1)
    a = rng.integers(-(2**20), 2**20, (5, 20_000)).astype(np.float64)
    b = rng.integers(-(2**20), 2**20, (7, 20_000)).astype(np.float64)
    expected = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    assert hard_negatives._scores(a, b).tolist() == expected


# Pages


@pytest.mark.parametrize("copies", [1, 3, 4, 50])
def test_equal_rows_of_a_page_keep_their_text(spark, copies):
    body = "".join(f"<p>Paragraph {i} of an article that says something.</p>" for i in range(6))
    page = f"<html><body><article><h2>Title</h2>{body}</article></body></html>"
    other = "".join(f"<div><p>{w} text</p><p>Follow us everywhere</p></div>" for w in ("one",))
    rows = [(1, "http://h/a", page)] * copies + [(i, f"http://h/{i}", f"<p>Text {i}</p>{other}") for i in range(2, 5)]
    done = page_wrapper.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    texts = [r["text"] for r in done.where("page_id = 1").collect()]
    expected = ["Title", *(f"Paragraph {i} of an article that says something." for i in range(6))]
    assert texts == ["\n\n".join(expected)] * copies


# Segmentation


def test_pieces_are_turned_back_in_the_same_pass(spark):
    texts = ["the cat, sat", None, "", "漢字 \x00 é", "word " * 5000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, text string, decoded string")
    once = sentencepiece_nbest.encode(df, decoded=True)
    twice = sentencepiece_nbest.decode(sentencepiece_nbest.encode(df))
    assert once.columns == ["i", "text", "ids", "score", "alternatives", "decoded"]
    key = ["i", "ids", "decoded"]
    assert sorted(map(str, once.select(key).collect())) == sorted(map(str, twice.select(key).collect()))
    assert {r["i"]: r["decoded"] for r in once.collect()} == dict(enumerate(texts))
