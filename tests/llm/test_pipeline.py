"""The stages of the corpus pipeline on a small table, against plain Python."""

import os
import random
import re
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from facetforge.llm.byte_bpe import encoding_of, rank_bytes
from facetforge.llm.order_minhash import similar
from facetforge.llm.source_mixing import mix_sources

NAMES = ["language ID", "line dedup", "MinHash near-dedup", "mixing", "byte BPE"]


def make_rows():
    rng = random.Random(8)
    english = "the of and house river people town water light stone green paper winter summer".split()
    german = "der die und haus fluss leute stadt wasser licht stein papier winter sommer".split()
    rows = []
    for i in range(60):
        lang, words = rng.choice([("en", english), ("de", german)])
        lines = [" ".join(rng.choices(words, k=rng.randrange(8, 40))) for _ in range(rng.randrange(1, 5))]
        if i % 6 == 0:
            lines.insert(1, "This line stands in many documents.")
        rows.append([i, "\n".join(lines), lang, rng.choice(["a", "b", None]), 0])
    rows[20][1] = rows[7][1]
    rows[30][1] = rows[8][1] + " more"
    rows += [[100, None, None, "a", 0], [101, "", "en", "b", 0], [102, "12 34 !!", "de", "b", 0]]
    return [tuple(r) for r in rows]


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(make_rows(), schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def plain_lines(rows):
    """Line dedup by hand."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    holders = {}
    for doc, text, *_ in rows:
        for line in text.split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    gone = {k: max(d) for k, d in holders.items() if len(k) >= 20 and len(d) >= 3}
    return [
        (doc, "\n".join(x for x in text.split("\n") if gone.get(key(x), doc) == doc), *rest)
        for doc, text, *rest in rows
    ]


def plain_near(rows):
    kept = {}
    for row in sorted(rows):
        linked = [k for k, other in kept.items() if any(similar(row[1], o[1]) for o in other)]
        merged = [row] + [o for k in linked for o in kept.pop(k)]
        kept[min(r[0] for r in merged)] = merged
    return [min(group) for group in kept.values()]


def test_stages_equal_plain_python(spark, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{documents}/documents.parquet")
    columns = docs.columns
    rows = [tuple(r) for r in docs.collect()]
    functions = [f for _, f in corpus_pipeline.STAGES]

    def stage(i, table):
        result = functions[i](spark, table, documents)
        assert i == 4 or result.columns == columns
        frame = [tuple(r) for r in result.collect()]
        schema = result.schema
        return frame, spark.createDataFrame(frame, schema)

    told, docs = stage(0, docs)
    wanted = [r for r in rows if re.search(r"[^\W\d_]", r[1] or "")]
    assert sorted(told, key=repr) == sorted(wanted, key=repr)

    deduped, docs = stage(1, docs)
    assert sorted(deduped, key=repr) == sorted(plain_lines(told), key=repr)

    one_each, docs = stage(2, docs)
    assert sorted(one_each, key=repr) == sorted(plain_near(deduped), key=repr)
    assert len(one_each) < len(deduped)

    mixed, taken = stage(3, docs)
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(docs).collect()}
    assert sorted(mixed, key=repr) == sorted((r for r in one_each for _ in range(copies[r[0]])), key=repr)

    tokens, _ = stage(4, taken)
    encoding = encoding_of(rank_bytes())
    assert sorted(tokens, key=repr) == sorted(
        ((r[0], r[3], encoding.encode_ordinary(r[1])) for r in mixed), key=repr
    )


def test_run_applies_the_stages(spark, documents):
    result = corpus_pipeline.run(spark, documents)
    assert result.columns == ["doc_id", "source", "ids"] and result.count() > 20


def test_empty_table(spark, no_docs):
    docs = no_docs.drop("n_lines")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_no_labelled_row_keeps_every_text_with_a_letter(spark):
    docs = spark.createDataFrame(
        [(1, "Some text", None), (2, None, None), (3, "12 ² !", None), (4, "ß", None)],
        "doc_id long, text string, lang string",
    )
    kept = corpus_pipeline.keep_known_language(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4]


def test_missing_language_is_filled_in(spark):
    rows = [(i, "der die und das haus ist gut", "de") for i in range(5)]
    rows += [(10 + i, "the of and house is good water", "en") for i in range(5)]
    rows += [(20, "das haus und die", None), (21, "the water of", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.keep_known_language(spark, docs, "").collect()}
    assert kept == {i: lang for i, _, lang in rows if lang} | {20: "de", 21: "en"}


CLASHING = ["lang_pred", "Score", "n_lines", "n_dropped", "size", "source_size", "target", "copies",
            "_again", "_kept_id", "_kept_key", "_own_size", "key", "id"]


def test_clashing_columns_repeated_rows_and_long_texts(spark):
    long = " ".join(f"word{i % 7001}" for i in range(130_000))  # over a million characters
    texts = [None, "", "Same text of some words again", "Same text of some words again", long,
             "Other words stand in this one", "123"]
    rows = [(i, t, "en", "s", *[f"{c}-{i}" for c in CLASHING]) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5]]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(
        f"`{c}` string" for c in CLASHING
    )
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", *CLASHING]
        for r in docs.collect():
            assert [r[c] for c in CLASHING] == [f"{c}-{r['doc_id']}" for c in CLASHING]
    assert {r["doc_id"] for r in docs.collect()} <= {2, 4, 5}
    tokens = corpus_pipeline.tokenise(spark, docs, "")
    encoding = encoding_of(rank_bytes())
    for r in tokens.collect():
        assert r["ids"] == encoding.encode_ordinary(texts[r["doc_id"]])


BARE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {shared!r}).getOrCreate())
import corpus_pipeline
from facetforge.llm import queries
for name in ("op7_language_id", "op11_periodic_runs", "op12_token_links"):
    assert queries.QUERIES[name](spark, {folder!r}).count() > 0, name
docs = spark.read.parquet({folder!r} + "/documents.parquet")
assert corpus_pipeline.STAGES[0][1](spark, docs, {folder!r}).count() > 0
"""


def test_workers_without_the_package(documents, tmp_path):
    """Only the driver can import the package."""
    root = str(Path(corpus_pipeline.__file__).resolve().parent)
    script = tmp_path / "bare.py"
    script.write_text(BARE.format(root=root, shared=str(tmp_path / "shared"), folder=documents))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("PYSPARK_GATEWAY")}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-3000:]
