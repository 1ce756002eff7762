from catalog import places  # noqa: F401  registers its queries
from catalog.registry import QUERIES


def test_every_sign_of_a_text_stays_but_marks(spark, tmp_path):
    """Capitals, digits, signs, line breaks and the text's own accents are in both results, none is left out."""
    texts = [(1, "Queen Kiwi, 12-3!\nÑandú Zoë ß"), (2, ""), (3, None), (4, "¿Où? (x_y) é 9%")]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["strip_accents_whole_text"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["latin"], r["any"]) for r in rows} == {
        1: ("ijueen 1⁄2i2ai, 12-3!\nNandu Aoe ß", "Quεεn Kiwi, 12-3!\nNαndu Zοe ß"),
        2: ("", ""),
        3: (None, None),
        4: ("¿Ou? (x_y) e 9%", "¿Ou? (x_η) e 9%"),
    }
