"""Queries against DuckDB, and rows that an operator may find odd, for all operators."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from placeleads.llm import (
    decontaminate,
    factor_dedup,
    line_dedup,
    ngram_join,
    page_wrapper,
    pii,
    quality_classifier,
    quality_rules,
    secret_scan,
    sentencepiece_nbest,
)
from placeleads.llm.oracle import LLM_ORACLE
from placeleads.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
LONG = "word " * 20_000 + "x" * 50_000
ODD = [
    (1, "Plain text of a few words. Mail a@b.co now."),
    (2, None),
    (3, ""),
    (4, " \n\t\n "),
    (5, LONG),
    (6, "Plain text of a few words. Mail a@b.co now."),
    (6, "Plain text of a few words. Mail a@b.co now."),
    (None, "Plain text of a few words. Mail a@b.co now."),
    (7, "é漢字🙂   \x00 end"),
]
# Columns that clash with those of the operators, in another case as well.
CLASH = (
    "doc_id long, text string, N_words string, kept string, score string, ids string, items string, "
    "starts string, row string, doc string, marked string, slot string, base string, pii string, own string"
)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, *("c" * 13)) for i, t in ODD]
    return spark.createDataFrame(rows, CLASH)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (5, 0), (5, 1), (None, 1), (6, None)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "a few words"), (1, "a few words"), (2, None), (3, ""), (None, "mail a"), (4, "zz")]
    return spark.createDataFrame(rows, "item_id long, text string")


OPERATORS = {
    "quality_rules": lambda d, labels, items: quality_rules.judge(d),
    "line_dedup": lambda d, labels, items: line_dedup.dedup_lines(d),
    "ngram_join": lambda d, labels, items: ngram_join.join_ngrams(d),
    "decontaminate": lambda d, labels, items: decontaminate.find_benchmark(d, items),
    "sentencepiece": lambda d, labels, items: sentencepiece_nbest.decode(sentencepiece_nbest.encode(d)),
    "pii": lambda d, labels, items: pii.find_pii(d),
    "secrets": lambda d, labels, items: secret_scan.find_secrets(d),
    "factors": lambda d, labels, items: factor_dedup.remove_repeats(d),
    "classifier": lambda d, labels, items: quality_classifier.score(d, quality_classifier.fit(d, labels)),
    "pages": lambda d, labels, items: page_wrapper.extract_text(
        d.select("doc_id", F.lit("http://h/").alias("url"), "text"), "doc_id", "url", "text"
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(name, odd, labels, items):
    done = OPERATORS[name](odd, labels, items)
    assert done.count() == len(ODD)
    assert len({c.lower() for c in done.columns}) == len(done.columns)
    empty = OPERATORS[name](odd.limit(0), labels.limit(0), items.limit(0))
    assert empty.count() == 0 and empty.schema == done.schema


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows_and_empty_tables(spark, odd, name, stage):
    docs = odd.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.lit(1)})
    done = stage(spark, docs, SF)
    assert done.count() <= len(ODD)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert set(done.columns) == set(docs.columns)
    assert stage(spark, docs.limit(0), SF).count() == 0


@pytest.mark.parametrize("name", LLM_ORACLE)
def test_queries_equal_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        connection.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    cursor = connection.execute(LLM_ORACLE[name])
    columns = [d[0] for d in cursor.description]
    expected = sorted(map(repr, cursor.fetchall()))
    got = LLM_QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(repr(tuple(r)) for r in got.select(columns).collect()) == expected


SPACES = " \t\n\x0b\x0c\r"
MENUS = [
    "Home > News > Sport > Football", "Home » Shop » Cart » Pay", "one | two three | four | five six seven eight nine",
    "wow! great! fine! good", "a > b, and c > d, but no e", "x! y! z w", "# # #", "·•·", "· a • b · c d e f • g",
    "See our Privacy Policy", "tail ! \r", "half! of! these words", "plain words only",
    "A | B | C | D | one long item of six words", "A | B | C | one long item of six words",
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def line_goes(line):
    """The line rules, written plainly."""
    own, low = words(line), line.lower()
    marks = sum(c in "#*$%&<>!" for c in line)
    items = re.split("[|>»›·•]", line)
    return (
        100 * marks > 20 * sum(map(len, own))
        or 100 * sum(w[-1] in "#*$%&<>!" for w in own) > 50 * len(own)
        or (len(items) > 3 and 100 * sum(len(words(i)) <= 4 for i in items) >= 80 * len(items))
        or any(phrase in low for phrase in quality_rules.BOILERPLATE)
    )


def plain_rules(text):
    """The text without lines that go, and None for a document that is rejected."""
    own = words(text or "")
    windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    often = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    left = "\n".join(x for x in (text or "").split("\n") if not line_goes(x))
    chars, rest = sum(map(len, own)), sum(map(len, words(left)))
    bad = len(own) < 20 or 100 * len(repeated) > 30 * len(own) or 100 * (chars - rest) > 50 * chars
    return None if bad else left


def test_line_rules_against_plain_loops_and_sql(spark, tmp_path):
    prose = " ".join(f"word{i}" for i in range(30))
    texts = [f"{prose}\n{menu}" for menu in MENUS] + ["\n".join([prose[: 40 * i], *MENUS]) for i in range(6)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    for i, text in enumerate(texts):
        assert got[i]["clean_text"] == "\n".join(x for x in text.split("\n") if not line_goes(x))
        assert got[i]["kept"] == (plain_rules(text) is not None)
    df.write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents/*.parquet')")
    rows = connection.execute(f"select doc_id, kept from ({LLM_ORACLE['op10_quality_rules']})").fetchall()
    assert dict(rows) == {i: r["kept"] for i, r in got.items()}


def test_pipeline_equals_plain_loops(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    texts = {r["doc_id"]: left for r in rows if (left := plain_rules(r["text"])) is not None}

    seen, cut = set(), {}
    for doc in sorted(texts):
        lines = line_dedup.numbered_lines(texts[doc])
        gone = set()
        for size in (1, 2, 3):
            for k in range(len(lines) - size + 1):
                run = lines[k : k + size]
                whole = size in (3, len(lines)) and sum(len(t) for _, t in run) >= line_dedup.MIN_CHARS
                short = size < 3 and sum(len(t.encode().split()) for _, t in run) >= line_dedup.PASSAGE_WORDS
                if whole or short:
                    passage = tuple(t for _, t in run)
                    gone |= {i for i, _ in run} if passage in seen else set()
                    seen.add(passage)
        if len(gone) < len(lines):
            cut[doc] = "\n".join(x for i, x in enumerate(texts[doc].split("\n")) if i not in gone)

    sets = {}
    for doc, text in cut.items():
        words = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
        width = min(5, len(words))
        sets[doc] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
    group = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]) and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    kept = {d: t for d, t in cut.items() if group[d] == d}

    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = set(decontaminate.windows_of([("x", t) for t in bench], 10))
    for doc in list(kept):
        ws = decontaminate.words(kept[doc])
        if any(tuple(ws[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(ws))):
            del kept[doc]
    assert set(got) == set(kept)
    assert all(r["round_trip"] for r in got.values())
    decoder = sentencepiece_nbest.Decoder(sentencepiece_nbest.read_vocabulary(sentencepiece_nbest.MODEL))
    assert all(decoder.decode(got[d]["ids"]) == kept[d] for d in kept)
