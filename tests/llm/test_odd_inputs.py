"""Large ids beside null ones, and columns named like those the operators add, for all operators and stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from smeltery.llm import (
    decontaminate, exact_dedup, jaccard_join, language_id, line_dedup, mixing, pii, token_rollup, toxicity, url_filter,
)

BIG = 2**53 + 1
ODD = ("_key", "_sha", "_doc", "asked", "blocks", "rule", "mark", "hub", "rep", "label", "found", "judged", "_judged",
       "content", "recipe", "digest", "n", "at", "window", "tokens", "kinds", "size", "place", "taken", "target")
TEXT = "a text of nine words that holds nothing at all"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(BIG, TEXT), (None, TEXT), (BIG + 2, "other words of another text that is not the same"), (None, None), (5, ""),
            (7, "you are worthless trash you idiot and all of it is trash")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.coalesce(1).withColumns({c: F.lit(c) for c in ODD})


@pytest.fixture(scope="module")
def labels(spark):
    toxic = [(i, 0, int(i % 2)) for i in range(200)]
    return spark.createDataFrame(toxic, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def index(spark, labels):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 1, F.concat(
        F.lit("worthless trash idiot "), "id")).otherwise(F.concat(F.lit("a fine day in the garden "), "id")).alias("text"))
    return toxicity.fit(docs, labels), docs


def ids(df, key="doc_id"):
    return sorted((r[key] for r in df.select(key).collect()), key=lambda i: (i is not None, i or 0))


ALL = [None, None, 5, 7, BIG, BIG + 2]


def test_ids_survive_the_operators(spark, odd, index, folder):
    assert ids(jaccard_join.jaccard_components(odd)) == ALL
    assert ids(pii.find(odd, None)) == ALL
    assert ids(exact_dedup.exact_duplicates(odd)) == ALL
    assert ids(toxicity.score_texts(odd, index[0])) == ALL
    assert ids(mixing.mix_by_source(odd)) <= ALL
    assert ids(language_id.predict(odd, language_id.fit(odd.select("text", "lang")))) == ALL
    assert ids(token_rollup.counted(odd, "byte_bpe_50k")) == ALL
    bench = spark.createDataFrame([(1, TEXT)], "item_id long, text string")
    judged = {(r["doc_id"], r["contaminated"]) for r in decontaminate.judged(odd, bench).collect()}
    assert judged == {(BIG, True), (None, True), (BIG + 2, False), (None, False), (5, False), (7, False)}
    lines = line_dedup.deduplicated(odd.where("doc_id IS NOT NULL"))
    assert set(ids(lines)) <= {5, 7, BIG, BIG + 2}


def test_columns_of_the_same_names_stay(spark, odd, index):
    bench = spark.createDataFrame([(1, TEXT)], "item_id long, text string")
    for kept in (exact_dedup.drop_exact_duplicates(odd), jaccard_join.one_of_each(odd), decontaminate.drop_contaminated(odd, bench)):
        assert kept.columns == odd.columns and {r["_key"] for r in kept.collect()} == {"_key"}
    rules = spark.createDataFrame([("example.org", "/a", "block")], "host string, path string, verdict string")
    pages = odd.withColumn("url", F.lit("http://www.example.org/a/b"))
    judged = url_filter.judge_urls(pages, rules)
    assert {(r["asked"], r["blocks"], r["verdict"]) for r in judged.collect()} == {("asked", "blocks", "block")}


def test_a_contaminated_row_without_id_takes_no_other_along(spark):
    docs = spark.createDataFrame([(None, TEXT), (None, "fine text of its own"), (1, "fine as well")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, TEXT)], "item_id long, text string")
    left = decontaminate.drop_contaminated(docs, bench)
    assert sorted(r["text"] for r in left.collect()) == ["fine as well", "fine text of its own"]


def test_stages_take_odd_and_empty_tables(spark, odd, labels, index, folder):
    learn = index[1].select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, TEXT)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    whole = learn.unionByName(odd.select(learn.columns)).withColumns({c: F.lit(c) for c in ODD})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, whole, folder)
        if name != "mixing":
            assert out.columns == whole.columns, name
            assert {r["_doc"] for r in out.select("_doc").distinct().collect()} == {"_doc"}
            got = ids(out)
            assert set(got) <= set(ids(whole)) and (BIG + 2 in got), name
        assert stage(spark, whole.limit(0), folder).count() == 0, name


def test_words_of_latin_and_other_texts():
    texts = ["The WAS_no 3rd naïve café's ÄÖÜß x²y µm ªº", "ÿ Ÿ œuvre “quoted” Ünï", "\x85a\xa0b\x1cc", "", "日本 x", None]
    for text in texts:
        assert toxicity.words_of(text) == toxicity._WORD.findall((text or "").lower())
