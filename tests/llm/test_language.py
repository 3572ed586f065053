from pyspark.sql import functions as F

from cirrus.llm import op5_language as L

from .conftest import SF


def test_held_out_accuracy(spark):
    got = L.query(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    known = got.where("held_out AND lang IS NOT NULL")
    assert known.where("lang = lang_pred").count() >= 0.9 * known.count() > 20


def test_odd_rows(spark, odd_docs, no_docs):
    model = L.learn(odd_docs)
    got = L.classify(odd_docs.withColumn("nearest", F.lit(1)), model, "doc_id").collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[3]["nearest"] == by[4]["nearest"] == by[5]["nearest"] == "und" and by[4]["score"] == 0
    assert by[10]["nearest"] in model and all(0 <= r["score"] <= 1 for r in got)
    assert L.learn(no_docs) == {} and L.classify(odd_docs, {}, "doc_id").where("nearest <> 'und'").count() == 0
    assert L.classify(no_docs, model, "doc_id").count() == 0


def test_languages_of_long_texts_are_learned(spark):
    """A language whose texts are all longer than a dictionary's quarter, holding a third of all rows as copies of one text."""
    spanish, english = "el perro que come la comida de los niños en casa ", "the dog that eats what children left at home "
    data = [(i, spanish * 700 + str(i % 5), "es") for i in range(40)] + [(100 + i, english * (i % 7 + 1) + str(i), "en")
                                                                        for i in range(20)]
    data += [(200 + i, english * 2, "en") for i in range(30)] + [(300, "", "fr"), (301, None, "fr")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = L.learn(docs)
    assert sorted(model) == ["en", "es"] and len(model["es"]) > 5 * 7000
    got = {r["doc_id"]: r["lang_pred"] for r in L.classify(docs, model, "doc_id").collect()}
    assert all(got[i] == lang for i, text, lang in data if text)


def test_sizes_and_answer_equal_plain_compression(spark):
    import zstandard
    learned = {"a": b"the cat sat on the mat " * 40, "b": b"le chat sur le tapis rouge " * 40}
    docs = spark.createDataFrame([(1, "the cat on the mat " * 500, "keep"), (2, "le chat rouge", "keep"), (3, "...", None)],
                                 "doc_id long, text string, nearest string")
    got = {r["doc_id"]: r for r in L.classify(docs.withColumnRenamed("nearest", "extra"), learned, "doc_id", "extra").collect()}
    for i, text in ((1, "the cat on the mat " * 500), (2, "le chat rouge")):
        size = {}
        for name, words in learned.items():
            plain = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            pack = zstandard.ZstdCompressor(level=L.LEVEL, dict_data=plain, write_content_size=False, write_checksum=False,
                                            write_dict_id=False)
            size[name] = sum(len(pack.compress(text[j: j + L.BLOCK].encode())) for j in range(0, len(text), L.BLOCK))
        assert got[i]["nearest"] == min(size, key=lambda n: (size[n], n)) and got[i]["extra"] == "keep"
    assert got[3]["nearest"] == "und" and got[3]["score"] == 0
