"""Rows and columns that a contract or a defined result names, one case each."""

from pyspark.sql import functions as F

from gridsmith.llm import language_id as L
from gridsmith.llm import mixing as M
from gridsmith.llm import token_binary as B
from gridsmith.llm import toxicity as T


def test_signs_outside_the_basic_plane_are_letters_only_if_python_says_so(spark):
    learn = spark.createDataFrame([("le chat est noir", "fr"), ("the cat is black", "en"), ("\U00010400\U00010428 \U00010400", "dsrt")],
                                  "text string, lang string")
    model = L.train(learn)
    asked = ["\U0001f600 \U0001f680\U0001f600", "the cat \U0001f600", "the cat 12", "\U00010400\U00010428", "12 \U0001f600", None]
    rows = {r.i: r for r in L.predict(spark.createDataFrame(list(enumerate(asked)), "i int, text string"), model, L.Params(), "i").collect()}
    assert [rows[i].lang_pred for i in range(6)] == ["und", "en", "en", "dsrt", "und", "und"]
    assert rows[0].score == rows[4].score == 0.0 and abs(rows[1].score - rows[2].score) < 1e-12


def test_mixing_takes_columns_with_its_own_names(spark, odd_docs):
    plain = sorted(map(repr, M.sample(odd_docs).collect()))
    names = ["__weight", "__source", "__topic", "cell", "mix", "raked"]
    more = odd_docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    got = M.sample(more)
    assert got.columns == more.columns
    assert sorted(map(repr, got.drop(*names).collect())) == plain


def test_chain_looks_only_at_the_columns_it_names(spark, odd_docs):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(10)], "doc_id long, quality int, toxic int")
    more = labels.withColumn("notes", F.create_map(F.lit("a"), F.lit(1))).withColumn("__id", F.lit(3))
    a, b = T.train(odd_docs, labels), T.train(odd_docs, more)
    assert a["names"] == b["names"] and (a["words"] == b["words"]).all()


def test_one_set_of_pieces_a_worker(spark):
    """Tasks of a worker share the tokenizer; results do not depend on what an earlier task left there."""
    import public_tokenizers
    from gridsmith.session import shared_dir
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("Some words, and"), F.col("id").cast("string")).alias("text"))
    out = []
    for _ in range(2):
        path = shared_dir(spark, "pieces")
        B.write_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"), 2, 16)
        out.append(sorted(map(tuple, B.read_documents(spark, path).collect())))
    assert out[0] == out[1] and len(out[0]) == 40


def test_batches_are_capped_and_never_raised(spark):
    from gridsmith.llm.common import small_batches
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for asked, then in (("64k", "64k"), ("64m", str(8 << 20)), ("1g", str(8 << 20)), (str(64 << 20), str(8 << 20)), ("4096", "4096")):
            spark.conf.set(key, asked)
            small_batches(spark)
            assert spark.conf.get(key) == then
    finally:
        spark.conf.set(key, before)
