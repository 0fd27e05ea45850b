import pytest
from pyspark.sql import functions as F

from quizlake.functions import segment as S
from quizlake.functions import text

CASES = [
    ("<em>Note to players: name the river.</em> This <b>river</b> flows (*) north.", 6, "This river flows  north.", 4),
    ("<em>Description acceptable</em>. This city has &amp;lt; ten gates.", 2, "This city has &lt; ten gates.", 6),
    ("<em>Macbeth</em> is set in this country (*) of glens.", 1, "Macbeth is set in this country  of glens.", 8),
    ("<em>Note to moderator: go slow</em> One (“WUN”) two ((TOO-oo)) three [THR-ee].", 5, "One two  three .", 4),
    ("<em>unterminated lead", 0, "unterminated lead", 2),
    ("Say [pause] it (emphasize) now [read slowly to end of sentence] ok.", 0, "Say  it  now  ok.", 4),
    ("plain &nbsp;text with (aside) kept", 0, "plain  text with (aside) kept", 5),
    ("x [[yy zz]] [[ y z ]] w", 0, "x [[yy zz]]  w", 4),
    ("mixed [pause) end", 0, "mixed  end", 2),
    ("a[pause](pause) b", 0, "a[pause] b", 2),
    ("<em>all of it</em>", 3, "all of it", 3),
    ("", 0, "", 0),
]


def test_sanitizer(spark):
    q = F.col("q")
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)] + [(99, None)], "i int, q string")
    got = {r.i: r for r in df.select("i", text.buzz_offset(q).alias("off"), text.sanitize(q).alias("clean"), text.token_count(text.sanitize(q)).alias("words")).collect()}
    for i, (_, off, clean, words) in enumerate(CASES):
        assert (got[i].off, got[i].clean, got[i].words) == (off, clean, words), CASES[i][0]
    assert got[99].clean is None


def test_char_index(spark):
    df = spark.createDataFrame([("aa bbb c", k) for k in (0, 1, 2, 5)], "t string, k int")
    assert [r[0] for r in df.select(text.char_index(text.tokens(F.col("t")), F.col("k"))).collect()] == [2, 6, 8, 11]


def test_category_main_and_position_classes(spark):
    rows = spark.createDataFrame([("science", "physics"), ("lit", "lit"), ("art", "visual art"), (None, "x")], "c string, s string")
    assert [r[0] for r in rows.select(text.category_main(F.col("c"), F.col("s"))).collect()] == ["science-physics", "lit", "visual art", None]
    d = spark.createDataFrame([(0,), (2,), (5,), (-5,), (-6,), (6,), (None,)], "d int")
    assert [r[0] for r in d.select(text.position_class(F.col("d"))).collect()] == ["exact", "within_2", "within_5", "within_5", "invalid", "large", None]


@pytest.mark.parametrize(
    ("value", "spans"),
    [
        ("one two three four five; six seven; eight nine ten eleven twelve; end", [(0, 24), (24, 65), (65, 69)]),
        ("it's one two three four five; six", [(0, 33)]),
        ("a; b", [(0, 4)]),
        ("", []),
        ('he said "one two three four; five" and then six; done', [(0, 48), (48, 53)]),
    ],
)
def test_semicolons(value, spans):
    assert S.semicolon_spans(value) == spans


def test_merges():
    t = "Short lead here. Then a much longer sentence follows it. and this one is lower. Final proper sentence is right here."
    assert S.merge_short(t, [(0, 16), (17, 56), (57, 79), (80, 116)]) == [(0, 79), (80, 116)]
    t = 'They sang "go home. Go now." Later everyone left the hall in silence.'
    assert S.merge_quotes(t, [(0, 19), (20, 28), (29, 69)]) == ([(0, 28), (29, 69)], False)
    assert S.merge_quotes('a "b c. d', [(0, 7), (8, 9)])[1] is False
    assert S.better([(0, 100)], [(0, 60), (61, 100)]) == [(0, 60), (61, 100)]
    assert S.better([(0, 50), (51, 100)], [(0, 60), (61, 100)]) == [(0, 50), (51, 100)]
    assert S.better([(0, 5), (6, 100)], [(0, 60), (61, 100)]) == [(0, 60), (61, 100)]
    assert S.realigned("A v. B ruled. / next", ["A v.", "B ruled.", "/ next"]) == [(0, 20)]
    with pytest.raises(RuntimeError):
        S.realigned("abc", ["x"])


def test_pipelines_give_ordered_spans_inside_the_text():
    texts = ["", "   ", "One.", 'He met J. F. Kett in Z39.50 and said "Go. Now." Then; he left; and so on.', "No end " * 90, 'a "b. c', "(((" * 50, "x. " * 500]
    for t in texts:
        for scheme, f in S.PIPELINES.items():
            spans = f(t)
            assert all(0 <= a < b <= len(t) for a, b in spans), (scheme, t)
            assert all(p[1] <= q[0] for p, q in zip(spans, spans[1:]))
            assert "".join("".join(t[a:b].split()) for a, b in spans) == "".join(t.split())


def test_unknown_scheme(spark):
    with pytest.raises(ValueError):
        S.clue_spans(F.col("q"), "other")
