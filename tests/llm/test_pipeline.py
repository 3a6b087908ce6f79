import corpus_pipeline
import __spark_entry__ as contract
from tallyhouse.llm import decontamination, jaccard_join, line_dedup
from tallyhouse.llm.common import stored
from tests.conftest import SF_DIR
from tests.llm import cases
from tests.llm.test_jaccard_join import families, plain_set
from tests.llm.test_lines_and_spans import plain_hits, plain_lines


def test_every_operator_has_a_query():
    names = contract.queries()
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names


def least_of_near_copies(rows, size=5, percent=80):
    """Least id of each class over all pairs whose runs of `size` words are alike."""
    sets, least = {i: plain_set(t, size) for i, t in rows}, {i: i for i, _ in rows}
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((least[i], least[j]))
                least = {k: low if c == high else c for k, c in least.items()}
    return set(least.values())


def test_stages_equal_the_plain_versions(spark):
    docs = stored(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "docs")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "line dedup", "n-gram jaccard join", "benchmark decontamination", "packing"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = stored(stages["quality classifier"](spark, docs, SF_DIR), "kept")
    assert kept.columns == columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    told = [i for i, q in labels.items()]
    assert sum((i in ids) == bool(labels[i]) for i in told) >= 0.95 * len(told)

    texts = {r.doc_id: r.text for r in kept.collect()}
    lined = stored(stages["line dedup"](spark, kept, SF_DIR), "lined")
    want = plain_lines(texts.items())
    want = {i: t for i, t in want.items() if t == texts[i] or t.strip()}
    rows = lined.collect()
    assert lined.columns == columns and {r.doc_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)

    single = stored(stages["n-gram jaccard join"](spark, lined, SF_DIR), "single")
    least = least_of_near_copies(want.items())
    assert single.columns == columns and {r.doc_id for r in single.collect()} == least

    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    clean = stored(stages["benchmark decontamination"](spark, single, SF_DIR), "clean")
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {i for i in least if not plain_hits(want[i], items)[1]}

    pieces = stages["packing"](spark, clean, SF_DIR)
    assert pieces.select("doc_id").distinct().count() == clean.count()


def test_near_copies_of_a_larger_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    left = {r.doc_id for r in dict(corpus_pipeline.STAGES)["n-gram jaccard join"](spark, docs, SF_DIR).collect()}
    assert left == least_of_near_copies([(r.doc_id, r.text) for r in docs.collect()])


def test_copies_with_blank_lines_go(spark):
    """Nothing but line feeds is left of the copy."""
    text = "\n\n".join(cases.prose(i, 60) for i in (1, 2, 3))
    docs = spark.createDataFrame([(i, text, "en", "src0", len(text)) for i in (1, 2)], cases.SCHEMA)
    left = dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, SF_DIR).collect()
    assert [(r.doc_id, r.text) for r in left] == [(1, text)]


def test_lines_are_cut_once(spark):
    """A filter on the cut text does not cut it again, in a second Python worker per task."""
    rows = [(1, "a b\nc d\ne f", "en", "src0", 11), (2, "a b\nc d\nx y", "en", "src0", 11), (3, "a b\nc d", "en", "src0", 7), (None, None, "en", "src0", 0)]
    left = dict(corpus_pipeline.STAGES)["line dedup"](spark, spark.createDataFrame(rows, cases.SCHEMA), SF_DIR)
    assert left._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert {(r.doc_id, r.text, r.n_chars) for r in left.collect()} == {(1, "a b\nc d\ne f", 11), (2, "x y", 3), (None, None, 0)}


def test_near_copies_share_runs_of_five_words(spark):
    """Four scattered words of 200 leave five-word runs 0.81 alike, three-word runs 0.89; five words 0.77."""
    words = cases.prose(7, 200, 4000).split()
    changed = lambda at: " ".join("other" if i in at else w for i, w in enumerate(words))
    rows = [(1, changed(())), (2, changed((20, 60, 100, 140))), (3, changed((10, 50, 90, 130, 170)))]
    rows += [(100 + i, t) for i, t in families(3, 25, (22, 40, 150, 400))]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], cases.SCHEMA).repartition(4)
    left = {r.doc_id for r in dict(corpus_pipeline.STAGES)["n-gram jaccard join"](spark, docs, SF_DIR).collect()}
    assert left == least_of_near_copies(rows) and 2 not in left and 3 in left


def test_stages_on_odd_rows(spark, tmp_path):
    """All rows go through all stages, and an empty table too."""
    spark.createDataFrame([(1, "equal rows are here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (cases.documents(spark, extra=True), cases.empty(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), "step")
            if name != "packing":
                assert docs.columns == columns
    assert docs.count() == 0


def test_modules_are_used():
    assert line_dedup.RUN >= 2 and jaccard_join.PERCENT == 90 and decontamination.SPAN == 10
