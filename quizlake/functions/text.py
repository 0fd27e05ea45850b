"""The markup sanitiser and token functions, all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: white space as Unicode has it
WS = r"[\s\x1c-\x1f]"
#: What the sanitiser deletes, in this order.
GUIDES = (
    r'\(\([“" ][^)]+[”" ]\)\)',
    r'\[\[[“" ][^)]+[”" ]\]\]',
    r"\(\([^\s)]*-[^\s)]*\)\)",
    r"\[\[[^\s)]*-[^\s)]*\]\]",
    r'\s\(["“][^)]+[”"]\)',
    r'\s\[["“][^)]+[”"]\]',
    r'\s\("?[^\s)]*-[^\s)]*\)',
    r"\[[^\s)]*-[^\s)]*\]",
)
MODERATOR = r"(\S*\s*)?[\[(](emphasize|pause|read slowly)[\])]"
TO_END = r"\[read slowly to end of sentence\]"
TAGS = r"</?(em|b|i|u)>"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
POWER = "(*)"


def _delete(q: Column, pattern: str) -> Column:
    return F.regexp_replace(q, "(?U)" + pattern, "")


def strip(q: Column) -> Column:
    return _delete(q, rf"^{WS}+|{WS}+$")


def remove_tags(q: Column) -> Column:
    return _delete(q, TAGS)


def instruction(q: Column) -> Column:
    """struct(text, instruction): the leading instruction and the text, from which it is cut only if it ends like one."""
    close = F.locate("</em>", q)
    start = F.when(close > 0, close + 4).otherwise(F.lit(4))
    dot = F.substring(q, start + 1, F.lit(1)) == "."
    start = start + dot.cast("int")
    led = q.startswith("<em>")
    note = strip(remove_tags(F.substring(q, F.lit(1), start)))
    cut = led & (note.startswith("Note to") | note.endswith(".") | dot)
    return F.struct(
        F.when(cut, strip(F.substring(q, start + 1, F.length(q)))).otherwise(q).alias("text"),
        F.when(led, note).otherwise(F.when(q.isNotNull(), F.lit(""))).alias("instruction"),
    )


def convert_entities(q: Column) -> Column:
    for a, b in ENTITIES:
        q = F.replace(q, F.lit(a), F.lit(b))
    return q


def remove_power_mark(q: Column) -> Column:
    return F.replace(q, F.lit(POWER), F.lit(""))


def remove_guides(q: Column) -> Column:
    for p in GUIDES:
        q = _delete(q, p)
    return q


def remove_moderator_notes(q: Column) -> Column:
    return _delete(F.regexp_replace(q, "(?U)" + MODERATOR, "$1"), TO_END)


def sanitize(q: Column) -> Column:
    return strip(remove_power_mark(remove_guides(remove_tags(remove_moderator_notes(convert_entities(instruction(q)["text"]))))))


def tokens(s: Column) -> Column:
    return F.filter(F.split(s, f"(?U){WS}+"), lambda x: x != "")


def token_count(s: Column) -> Column:
    return F.size(tokens(s))


def buzz_offset(q: Column) -> Column:
    """Words of the instruction, whether or not it was cut."""
    return token_count(instruction(q)["instruction"])


def char_index(words: Column, k: Column) -> Column:
    """End of word k (from 0) if the words stood one space apart; beyond the end k still adds k."""
    return F.aggregate(F.slice(words, F.lit(1), k + 1), F.lit(0), lambda a, w: a + F.length(w)) + k


def straight_quotes(q: Column) -> Column:
    return F.translate(q, "“”", '""')


def apply_spans(q: Column, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.substring(q, s["start"] + 1, s["end"] - s["start"]))


def first_token(s: Column) -> Column:
    return F.try_element_at(tokens(s), F.lit(1))


def highlight(q: Column, pattern: str) -> Column:
    return F.regexp_replace(q, f"(?U)({pattern})", '<span class="hit">$1</span>')


def category_main(category: Column, subcategory: Column) -> Column:
    plain = subcategory.startswith(category) | subcategory.endswith(category)
    return F.when(plain, subcategory).when(category.isNotNull() & subcategory.isNotNull(), F.concat(category, F.lit("-"), subcategory))


def is_redundant_main(category: Column, subcategory: Column, main: Column) -> Column:
    """Whether a stored main category says no more than the category and the subcategory do."""
    return F.coalesce((main == F.concat(category, F.lit("-"), subcategory)) | (main == subcategory), F.lit(False))


def n_matches(q: Column, pattern: str) -> Column:
    return F.regexp_count(q, F.lit("(?U)" + pattern))


def token_html(words: Column) -> Column:
    """The words as one line of HTML, each under its position from 0."""
    return F.array_join(F.transform(words, lambda w, k: F.concat(F.lit('<span class="token" title="'), k.cast("string"), F.lit('">'), w, F.lit("</span>"))), "")


def open_quotes(q: Column) -> Column:
    """struct(quote, both): the sign of a quotation that is not closed, the straight one first, and whether both kinds are open."""
    straight = F.length(q) - F.length(F.replace(q, F.lit('"'), F.lit("")))
    curly = F.length(F.replace(q, F.lit("”"), F.lit(""))) - F.length(F.replace(q, F.lit("“"), F.lit("")))
    odd, more = straight % 2 == 1, curly > 0
    return F.struct(F.when(odd, '"').when(more, "“").alias("quote"), (odd & more).alias("both"))


def aligned(position: Column, offset: Column) -> Column:
    """Position without the instruction's words, at least 0; null stays null."""
    return F.when(position.isNotNull(), F.greatest(position - offset, F.lit(0)))


def position_class(difference: Column) -> Column:
    """How far the last buzz is from the number of words."""
    return (
        F.when(difference == 0, "exact").when(F.abs(difference) <= 2, "within_2").when(F.abs(difference) <= 5, "within_5")
        .when(difference < 0, "invalid").when(difference.isNotNull(), "large")
    )
