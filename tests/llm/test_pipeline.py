"""The pipeline's stages, each against a brute-force version on its own input."""

import os
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")

from logweave.llm import quality  # noqa: E402
from test_decontaminate import plain  # noqa: E402
from test_native_operators import plain_quality  # noqa: E402
from test_simhash import plain_similar  # noqa: E402
from test_token_operators import check_packing  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF_DIR), reason="no test tables")


def failing(line):
    chars = len(re.sub(r"[\x20\x09-\x0D]", "", line))
    words = len(re.findall(r"[\x20\x09-\x0D]", line.strip(" \t\n\x0b\f\r"))) + 1
    links = len(re.findall("[|»›]", line))
    if not chars:
        return False
    marks = len(re.findall(r"[#*$%&|<>]", line)) > 0.1 * chars or line.count("!") > max(2, 0.25 * words)
    return links >= 3 and links > 0.25 * words or marks or words < 30 and any(p in line.lower() for p in quality.BOILERPLATE)


def plain_clean(text):
    lines = (text or "").split("\n")
    size = lambda xs: sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x in xs)
    lost = size([x for x in lines if failing(x)])
    return None if plain_quality(text)[-1] or lost > 0.3 * size(lines) else "\n".join(x for x in lines if not failing(x))


def plain_lines(docs):
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    first = {}
    for i, text in docs.items():
        for line in text.split("\n"):
            first[key(line)] = min(first.get(key(line), i), i)
    return {i: "\n".join(x for x in text.split("\n") if len(key(x)) < 10 or first[key(x)] == i) for i, text in docs.items()}


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "best-fit packing"]
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k == 4:
            rows = docs.collect()
            assert {r["doc_id"] for r in rows} == set(before)
            at = {i: n for n, i in enumerate(before)}
            renamed = [r.asDict() | {"doc_id": at[r["doc_id"]]} for r in rows]
            assert check_packing(renamed, list(before.values()), 4096) == -(-sum(r["length"] for r in rows) // 4096)
            break
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect()) or k == 2
        if k == 0:
            want = {i: plain_clean(t) for i, t in before.items()}
            want = {i: t for i, t in want.items() if t is not None}
        elif k == 1:
            want = plain_lines(before)
        elif k == 2:
            least = plain_similar(before, 0.8)
            want = {i: before[i] for i in before if least[i] == i}
        else:
            told = {i: plain(t, items, 10) for i, t in before.items()}
            want = {i: before[i] for i in before if told[i][1] == 0}
            assert all(after[i] == want[i] for i in want)
            assert set(after) == {i for i, (n, hit, _) in told.items() if hit <= 0.5 * n}
            assert all(plain(after[i], items, 10)[1] < told[i][1] for i in after if told[i][1])
            continue
        assert after == want, name


def test_run_gives_what_the_stages_give(spark):
    done = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "sequence_id", "offset"} <= set(done.columns) and done.count() > 100


def test_stages_take_nulls_and_empty_tables(spark, tmp_path):
    good = " ".join(f"word{k}" for k in range(90))
    rows = [(None, good, None, None, None), (4, None, "en", "s", 0), (5, good, None, "s", 1), (5, good, None, "s", 1), (6, good + " and more", "en", None, 2), (7, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for some, least in ((rows, 1), ([], 0)):
        docs = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        assert docs.count() >= least
