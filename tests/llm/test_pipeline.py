import brute
import corpus_pipeline as cp

from pyspark.sql import functions as F

from merchlens.llm import mixing, queries, toxicity


def test_every_stage_against_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in cp.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "source mixing", "SentencePiece"]
    for k, (name, stage) in enumerate(cp.STAGES):
        rows = [tuple(r) for r in docs.collect()]
        out = str(tmp_path / str(k))
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        got = [tuple(r) for r in docs.collect()]
        if name != "SentencePiece":
            assert docs.columns == columns
        if name == "toxicity":
            labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out())
            model = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
            top = toxicity._Scorer(model).top([r[1] or "" for r in rows])
            want = [r for r, p in zip(rows, model.probability(top), strict=True) if p < 0.5]
        elif name == "line dedup":
            texts = [t for _, _, t in brute.kept_lines([r[:2] for r in rows])]
            want = [(r[0], t, *r[2:4], len(t)) for r, t in zip(rows, texts, strict=True)]
        elif name == "n-gram Jaccard join":
            want = [r for r, (i, _, c) in zip(rows, brute.jaccard_components([r[:2] for r in rows]), strict=True) if i == c]
        elif name == "source mixing":
            where = {"src0": "crawl", **{f"src{i}": "curated" for i in range(1, 10)}}
            tree = [(r[0], r[1], where.get(r[3], "reference"), r[2], r[3]) for r in rows]
            taken = {i for i, _ in brute.mixed(tree, [mixing.WEIGHTS[k] for k in mixing.LEVELS], cp.MIX_SHARE, 1)}
            want = [r for r in rows if r[0] in taken]
            assert 0 < len(want) < len(rows)
        else:
            assert sorted((r[0], r[3]) for r in got) == sorted((r[0], brute.sha(r[1] or "")) for r in rows)
            assert all(r[1] == len(r[2]) for r in got)
            continue
        assert sorted(got) == sorted(want), name


def test_run_gives_coded_documents(spark, sf_dir):
    ids = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()}
    got = cp.run(spark, sf_dir).select("doc_id", "n_tokens").collect()
    assert 0 < len(got) < len(ids) and {r.doc_id for r in got} <= ids and len({r.doc_id for r in got}) == len(got)


def test_every_operator_has_its_query():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14)) and set(queries.SQL) <= set(queries.QUERIES)
    assert cp.ORACLE_SQL is None


def test_columns_that_clash_with_an_operators_own_keep_their_values(spark, sf_dir):
    extra = {"domain": "d", "tokens": "t", "epoch": "e", "N_Lines": "n", "n_dropped": "x", "Toxicity_Score": "s", "score": "z", "row": "r"}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({c: F.lit(v) for c, v in extra.items()})
    names = docs.columns
    for name, function in cp.STAGES[:-1]:
        docs = function(spark, docs, sf_dir)
        assert docs.columns == names, name
        wrong = docs.filter(" or ".join(f"`{c}` <> '{v}'" for c, v in extra.items()))
        assert docs.count() > 0 and wrong.count() == 0, name
