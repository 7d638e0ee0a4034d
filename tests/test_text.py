import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from touchline.functions import text as X
from touchline.vocabulary import THEME_KEYWORDS

CASES = [
    ("La VAR a tout revu hier", [], ["var"]),
    ("On en parle", ["OL", "VAR"], ["var"]),
    ("Ses stats et ses xG montent", [], ["stats_analytics"]),
    ("Ce soir, analyse video du but", [], ["analyse_video"]),
    ("Une VAR, des stats, puis une analyse video", [], ["analyse_video", "stats_analytics", "var"]),
    ("Rien de neuf au stade", [], []),
    ("Notre analyse vidéo", [], ["analyse_video"]),
    (None, None, []),
    (None, ["opta"], ["stats_analytics"]),
    ("Le temps varie souvent", [], []),
    ("texte", ["variete"], ["var"]),
    ("hors-jeu", [], []),
    ("hors jeu", [], ["var"]),
    ("texte", ["Hors-Jeu"], ["var"]),
    ("texte", ["hors jeu"], []),
    ("ＶＡＲ", [], ["var"]),
    ("var_", [], []),
    ("яvar", [], []),
    ("xG²", [], []),
    ("VAR™", [], []),
    ("VAR…", [], ["var"]),
    ("½var", [], []),
    ("la VAR", [], ["var"]),
    ("hors jeu", [], ["var"]),
    ("v́är", [], ["var"]),
    ("한var", [], []),
    ("한 var", [], ["var"]),
    ("texte", [None, "", "XG"], ["stats_analytics"]),
    ("une analyse d'image", [], ["analyse_video"]),
    ("texte", ["analysedimage"], []),
    ("texte", ["AnalyseD'Image"], ["analyse_video"]),
    ("texte", ["va", "r"], []),
    ("", [], []),
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(i, t, h) for i, (t, h, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "i int, text string, hashtags array<string>")


def _themes(df):
    return {r.i: r.themes for r in df.select("i", "themes").collect()}


EXPECTED = {i: themes for i, (_, _, themes) in enumerate(CASES)}


def test_staged_themes(cases):
    assert _themes(X.with_themes(cases)) == EXPECTED


def test_theme_expression(cases):
    assert _themes(cases.withColumn("themes", X.tag_themes(F.col("text"), F.col("hashtags")))) == EXPECTED


def test_theme_udf(cases):
    assert _themes(cases.withColumn("themes", X.tag_themes_udf()("text", "hashtags"))) == EXPECTED


def test_custom_themes_with_symbol_keywords(spark):
    df = spark.createDataFrame([("a c++ b", []), ("c++x", []), ("x#1", [])], "text string, hashtags array<string>")
    tagged = X.with_themes(df, themes={"cpp": ["c++"], "one": ["#1"]})
    # A boundary after "+" needs a word character there, as \b has it.
    assert [r.themes for r in tagged.collect()] == [[], ["cpp"], ["one"]]


def test_empty_keyword_is_refused():
    with pytest.raises(ValueError):
        X.whole_word_pattern([X.fold("́")])


def test_normalisation_equals_unicode_rules_on_every_code_point(spark):
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    frame = spark.createDataFrame(pd.DataFrame({"c": codes, "s": [f"a{chr(c)}b" for c in codes]}))
    result = frame.select("c", X.normalize_text("s").alias("n")).toPandas()
    different = [c for c, n in zip(result.c, result.n) if n != X.fold(f"a{chr(c)}b")]
    # The JVM may know case pairs of a later Unicode version; only letters without
    # a decomposition can be concerned.
    assert all(not unicodedata.decomposition(chr(c)) for c in different)
    assert len(different) < 60


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,), ("É",)], "s string")
    assert [r[0] for r in df.select(X.normalize_text("s")).collect()] == [None, "e"]


def test_whole_documents_match_the_udf(spark):
    from touchline.plans import inputs

    posts = inputs.posts(spark, "/root/testdata/sf0.001")
    both = X.with_themes(posts).withColumn("slow", X.tag_themes_udf()("text", "hashtags"))
    assert both.where("themes <> slow").count() == 0
    assert both.where("size(themes) > 0").count() > 0


def test_theme_order_is_declaration_order(cases):
    order = list(THEME_KEYWORDS)
    for themes in _themes(X.with_themes(cases)).values():
        assert themes == sorted(themes, key=order.index)
