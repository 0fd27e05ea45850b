"""Mapping freely typed values to the entries of a canonical list.

Distinct values are normalised and looked up in an inverted index of the character n-grams of all known forms: the
canonical names and slugs, and aliases (``ALIASES``: translations, abbreviations, other names). The candidates are
scored by the mean of weighted cosine and edit similarity of the whole strings (a transposition is one edit); a candidate
is passed over only when its cosine and the lengths leave it no chance. The best entry is accepted above ``ACCEPT`` and with
``MARGIN`` over the next entry.

A name that is not listed may be spelt like one that is. So an accepted value that is no known form is held against what
the other columns of its rows say, counted over all rows: each row that names the same category speaks for the entry, each
that names another one against it (``log_odds``), beside the odds that the score gives. This confirms or vetoes what the score has accepted,
with weights that grow evenly from the first row on; it never maps a value by itself.

A subcategory is scored with its category as context: forms of subcategories under that category are preferred, and a
bare word of a name (``World``, ``Music``) is one of its forms there.

Defined results: null and blank values are not mapped and not reported; a value that means no entry is reported with
entry 0; equal scores go to the least entry id and, being without margin, count as unmatched; repeated rows give one
row; an empty reference list leaves every value unmatched; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlake.session import cut

ACCEPT = 0.46
MARGIN = 0.015
#: share of rows in which the other columns name some other category than the one that is meant
ASTRAY = 0.2
#: log odds of an accepted value by its score alone: none at ``EVEN``, and so many for each point above it
EVEN, STEEP = ACCEPT, 6.0
SALTS = 16
#: distinct values that one task looks up
VALUES_PER_TASK = 250
#: the reference list is read whole by the driver; a longer one is refused rather than cut
MAX_ENTRIES = 20_000

#: Other names of the listed subjects.
ALIASES = {
    "literature": "lit, litt, letters, lit & letters, literatur, literatura, littérature, belles lettres, 文学, λογοτεχνία",
    "history": "hist, past, the past, geschichte, historia, histoire, 历史",
    "science": "sci, stem, natural science, natural sciences, naturwissenschaft, ciencia, ciencias, sciences, 科学",
    "fine-arts": "fa, art, arts, the arts, kunst, beaux-arts, bellas artes, visual arts, 艺术",
    "religion": "rel, relig, faith, faiths, rmp religion, religión, glaube, 宗教",
    "mythology": "myth, myths, legends & myth, mythologie, mitología, 神话",
    "philosophy": "phil, philo, philosophie, filosofía, rmp philosophy, 哲学",
    "social-science": "ss, soc sci, social sci, social sciences, sozialwissenschaft, ciencias sociales, sciences sociales, 社会科学",
    "geography": "geo, geog, erdkunde, geografía, géographie, geographie, 地理",
    "current-events": "ce, news, current affairs, curr events, actualidad, actualité, aktuelles, 时事",
    "popular-culture": "pop, trash, pop culture, popkultur, cultura pop, culture populaire, 流行文化",
    "american-literature": "am lit, amer lit, us lit, us literature, american lit",
    "british-literature": "brit lit, uk lit, english lit, british lit",
    "european-literature": "euro lit, eur literature, european lit, continental lit",
    "world-literature": "world lit, non-western lit, global lit",
    "classical-literature": "classics lit, greco-roman lit, classical lit, class lit",
    "poetry": "verse, poems, poem",
    "american-history": "am hist, amer hist, us history, us hist, american hist",
    "british-history": "brit hist, uk history, uk hist, british hist",
    "european-history": "euro hist, eur history, european hist, continental history",
    "world-history": "world hist, global history, non-western history",
    "ancient-history": "anc hist, antiquity, ancient hist, classical history",
    "archaeology": "archeo, archeology, digs",
    "biology": "bio, life sci, life science, biologie",
    "chemistry": "chem, chemie",
    "physics": "phys, physik",
    "mathematics": "math, maths, mathematik",
    "earth-science": "earth sci, geosci, geoscience",
    "astronomy": "astro, space sci, space science, astronomie",
    "computer-science": "cs, comp sci, computing, compsci, informatik",
    "painting": "paintings, visual art painting, malerei",
    "sculpture": "sculp, statuary, sculptures",
    "classical-music": "class music, orchestral, orchestral music",
    "opera": "operas, lyric theatre",
    "architecture": "arch, buildings",
    "film": "films, movies, cinema",
    "photography": "photo, photos",
    "scripture": "scrip, holy texts, scriptures",
    "religious-practice": "rel practice, rites, practices, worship",
    "church-leaders": "clergy, prelates",
    "norse-mythology": "norse myth, viking myth",
    "greek-mythology": "greek myth, hellenic myth",
    "world-mythology": "world myth, other myth",
    "ethics": "ethic, moral phil, morals",
    "logic": "formal logic, logic & language",
    "political-thought": "polit phil, pol thought, political philosophy",
    "economics": "econ",
    "psychology": "psych, psy",
    "sociology": "soc, socio",
    "anthropology": "anthro, anth",
    "linguistics": "ling, langs, language science",
    "physical-geography": "phys geo, landforms, physical geo",
    "human-geography": "human geo, peoples",
    "domestic-news": "dom news, home news, national news",
    "foreign-news": "world news, for news, news abroad",
    "sports": "sport, athletics",
    "television": "tv, tele, shows",
    "video-games": "vg, gaming, games",
    "popular-music": "pop music, pop songs, charts",
}

_SPLIT = re.compile(r"\s+[-–—]\s+|\s*[:/>|]\s*")


def normal(value: str) -> str:
    """Lower-case letters, digits and single spaces: marks, numbering and prefixes that typing adds are gone."""
    v = unicodedata.normalize("NFKC", value).replace("ı", "i")
    v = re.sub(r"(?<=[a-zß-ÿ])(?=[A-Z][a-z])", " ", v)
    v = v.casefold().strip()
    v = re.sub(r"\(\s*\d+\s*\)\s*$", "", v)
    v = re.sub(r"^/|^cat-(?=\w)", "", v.strip())
    v = re.sub(r"-\d+$|-$", "", v)
    v = "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c))
    v = re.sub(r"[^\w&]+|_+", " ", v)
    return " ".join(v.split())


def grams(text: str) -> Counter:
    """Weighted n-grams of a form: letters, pairs, pairs over a letter, triples; spaces don't count."""
    s = "^" + text.replace(" ", "") + "$"
    out: Counter = Counter()
    for c in s[1:-1]:
        out[c] += 0.35
    for k in range(len(s) - 1):
        out[s[k : k + 2]] += 1.0
    for k in range(len(s) - 2):
        out[s[k] + "." + s[k + 2]] += 0.6
        out[s[k : k + 3]] += 0.8
    return out


def edits(a: str, b: str) -> int:
    """Edit distance with transpositions of neighbours."""
    if a == b:
        return 0
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]  # what both begin and end with costs nothing
    if not a or not b:
        return len(a) + len(b)
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        before, last = last, row
    return last[-1]


class Index:
    """Inverted index of forms: (entry id, parent id, form)."""

    def __init__(self, forms: list[tuple[int, int, str]]):
        self.forms = sorted(set(forms))
        bags = [grams(f) for _, _, f in self.forms]
        seen = Counter(g for b in bags for g in b)
        n = len(bags) or 1
        self.weight = {g: math.log(1 + n / c) for g, c in seen.items()}
        self.rare = math.log(1 + n)
        self.posting: dict[str, list[tuple[int, float]]] = defaultdict(list)
        self.exact: dict[str, list[int]] = defaultdict(list)
        for i, (b, (_, _, f)) in enumerate(zip(bags, self.forms)):
            norm = math.sqrt(sum((x * self.weight[g]) ** 2 for g, x in b.items()))
            for g, x in b.items():
                self.posting[g].append((i, x * self.weight[g] / norm))
            self.exact[f.replace(" ", "")].append(i)

    def scores(self, text: str, parent: int = 0) -> dict[int, float]:
        """Best cosine of each entry. Forms under another parent than the given one count a little less."""
        b = grams(text)
        own = {g: x * self.weight.get(g, self.rare) for g, x in b.items()}
        norm = math.sqrt(sum(x * x for x in own.values())) or 1.0
        hit: dict[int, float] = defaultdict(float)
        for g, x in own.items():
            for i, y in self.posting.get(g, ()):
                hit[i] += x * y / norm
        for i in self.exact.get(text.replace(" ", ""), ()):
            hit[i] = 1.0
        out: dict[int, float] = {}
        solid = text.replace(" ", "")
        near = sorted(hit.items(), key=lambda x: (-x[1], x[0]))
        exact = bool(near) and near[0][1] >= 1.0
        best = 0.0
        for i, s in near:
            entry, p, form = self.forms[i]
            if not exact:
                if (s + 1) / 2 < max(best, ACCEPT) - MARGIN:  # nor can any further one come near the best
                    break
                f = form.replace(" ", "")
                longest = max(len(solid), len(f))
                if (s + min(len(solid), len(f)) / longest) / 2 < max(best, ACCEPT) - MARGIN:
                    continue
                s = (s + 1 - edits(solid, f) / longest) / 2
            if parent and p and p != parent:
                s *= 0.9
            if s > out.get(entry, 0.0):
                out[entry] = s
                best = max(best, s)
        return out


def forms(entries: list[tuple[int, str, str, str, int | None]], kind: str) -> list[tuple[int, int, str]]:
    """The forms of one kind's entries (id, kind, name, slug, parent) and of their aliases."""
    own = [e for e in entries if e[1] == kind]
    words = Counter(w for e in own for w in normal(e[2]).split())
    out = []
    for e, _, name, slug, parent in own:
        known = [name, slug, *ALIASES.get(slug, "").split(",")]
        out += [(e, parent or 0, normal(f)) for f in known if normal(f)]
        parts = normal(name).split()
        if len(parts) > 1 and kind != "category":
            out += [(e, parent or 0, w) for w in parts]
    return out


def readings(value: str, kind: str) -> list[tuple[str, float]]:
    """The whole value and its parts, in the order in which they speak for the kind."""
    whole = normal(value)
    parts = [p for p in (normal(p) for p in _SPLIT.split(value.strip().strip("*?./ \xa0"))) if p]
    if len(parts) < 2:
        return [(whole, 1.0)]
    main = parts[0] if kind == "category" else parts[-1]
    return [(main, 1.0), (whole, 1.0)]


def decide(value: str, kind: str, index: Index, parent: int = 0) -> tuple[int, float, float]:
    """(entry, score, margin); entry 0 for one that is not listed."""
    best: dict[int, float] = {}
    for text, factor in readings(value, kind):
        if not re.search(r"[^\W\d_]", text):
            continue
        for e, s in index.scores(text, parent).items():
            best[e] = max(best.get(e, 0.0), s * factor)
    if not best:
        return 0, 0.0, 0.0
    ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))
    e, s = ranked[0]
    return e, s, s - (ranked[1][1] if len(ranked) > 1 else 0.0)


def lookup(values: DataFrame, entries: list[tuple], kind: str) -> DataFrame:
    """values (value, parent) with entry, score, margin; entry 0 unless it is accepted. The list is bounded, so its index is sent out whole."""
    values = cut(values)
    # the work lies in the number of values, not in their bytes
    tasks = values.count() // VALUES_PER_TASK + 1
    shared = values.sparkSession.sparkContext.broadcast(Index(forms(entries, kind)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [decide(v, kind, shared.value, p) for v, p in zip(b["value"], b["parent"])]
            yield pd.DataFrame({"value": b["value"], "parent": b["parent"], "entry": [g[0] for g in got], "score": [g[1] for g in got], "margin": [g[2] for g in got]})

    found = values.repartition(tasks, "value", "parent").mapInPandas(run, "value string, parent long, entry long, score double, margin double")
    return cut(found.withColumn("entry", F.when((F.col("score") >= ACCEPT) & (F.col("margin") >= MARGIN), F.col("entry")).otherwise(F.lit(0))))


def filled(c: str | Column) -> Column:
    """The value, null where it is blank (white space of any alphabet)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f ​]+", "") != "", c)


def attach(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of rows with a table that is unique in ``keys``; rows of a hot value are spread over the salts."""
    spread = found.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(spread, [*keys, "__salt"], "left").drop("__salt")


def log_odds(n_same: Column, n_all: Column, share: Column) -> Column:
    """What rows say for an entry: n_same of n_all name its category, which ``share`` of all rows name."""
    against = math.log(ASTRAY)
    return n_all * F.lit(against) + n_same * (F.log((1 - ASTRAY) / share + ASTRAY) - F.lit(against))


def confirmed(found: DataFrame, counted: DataFrame) -> DataFrame:
    """value, parent, entry of the found values (with home, the category that their entry stands for), 0 where the rows speak
    against it. counted: value, hint (the category that other columns name, if any), n."""
    same = F.lower(F.trim(F.regexp_replace("value", r"(?U)[^\p{L}\p{N}]+", " ")))
    said = cut(counted.where("hint > 0").groupBy(same.alias("form"), "hint").agg(F.sum("n").alias("n")))
    shares = said.groupBy("hint").agg(F.sum("n").alias("s")).join(said.agg(F.sum("n").alias("all")), F.lit(True)).select(F.col("hint").alias("home"), (F.col("s") / F.col("all")).alias("share"))  # a row per category
    rows = found.withColumn("form", same).join(said.groupBy("form").agg(F.sum("n").alias("n_all")), "form", "left")
    rows = rows.join(said.select("form", F.col("hint").alias("home"), F.col("n").alias("n_same")), ["form", "home"], "left").join(shares, "home", "left")
    n_all, n_same = F.coalesce("n_all", F.lit(0)), F.coalesce("n_same", F.lit(0))
    odds = F.lit(STEEP) * (F.col("score") - F.lit(EVEN)) + log_odds(n_same, n_all, F.coalesce("share", F.lit(1.0)))
    return rows.select("value", "parent", F.when((F.col("score") >= 0.999) | (odds > 0), F.col("entry")).otherwise(F.lit(0)).cast("long").alias("entry"))


def _resolve(rows: DataFrame, column: str, entries: list[tuple], kind: str, hint: Column) -> DataFrame:
    """value -> entry for one column: by its text, confirmed by the hints of its rows. rows: id, columns, hint."""
    own = rows.select(F.col(column).alias("value"), hint.alias("hint")).where("value is not null")
    counted = cut(own.groupBy("value", "hint").agg(F.count(F.lit(1)).alias("n")))
    by_text = lookup(counted.select("value", F.lit(0).cast("long").alias("parent")).distinct(), entries, kind)
    return confirmed(by_text.withColumn("home", F.col("entry")), counted).select("value", "entry")


def map_questions(questions: DataFrame, reference: DataFrame) -> DataFrame:
    """question_id, field_name, entry_id of every value that is not the canonical string of its entry."""
    entries = [tuple(r) for r in reference.select("entry_id", "entry_kind", "name", "slug", "parent_id").where("entry_id is not null and name is not null").orderBy("entry_id").limit(MAX_ENTRIES + 1).toLocalIterator()]
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"the reference list has more than {MAX_ENTRIES} entries")
    rows = questions.select(F.col("id"), filled("category").alias("category"), filled("category_slug").alias("category_slug"), filled("subcategory").alias("subcategory"))

    def small(known: dict, schema: str) -> DataFrame:
        return questions.sparkSession.createDataFrame(list(known.items()), schema)

    exact = {k: {e[2 if k == "name" else 3]: e[0] for e in entries if e[1] == "category"} for k in ("name", "slug")}
    parent = {e[2]: e[4] for e in entries if e[1] == "subcategory" and e[4]}

    def said(df: DataFrame, c: str, known: dict, name: str) -> DataFrame:  # what a column says when it holds a canonical string
        return df.join(F.broadcast(small(known, f"{c} string, {name} bigint")), c, "left")  # at most MAX_ENTRIES rows

    rows = said(said(said(rows, "category_slug", exact["slug"], "by_slug"), "category", exact["name"], "by_name"), "subcategory", parent, "by_sub")
    by_slug, by_name, by_sub = F.col("by_slug"), F.col("by_name"), F.col("by_sub")
    cat = _resolve(rows, "category", entries, "category", F.coalesce(by_slug, by_sub))
    slug = _resolve(rows, "category_slug", entries, "category", F.coalesce(by_name, by_sub))
    rows = attach(rows, cat.select(F.col("value").alias("category"), F.col("entry").alias("cat_entry")), ["category"])
    rows = attach(rows, slug.select(F.col("value").alias("category_slug"), F.col("entry").alias("slug_entry")), ["category_slug"])
    rows = cut(rows.withColumn("light", F.coalesce(F.when(F.col("cat_entry") > 0, F.col("cat_entry")), F.when(F.col("slug_entry") > 0, F.col("slug_entry")), F.lit(0)).cast("long")))
    pairs = cut(rows.where("subcategory is not null").groupBy(F.col("subcategory").alias("value"), F.col("light").alias("parent")).agg(F.count(F.lit(1)).alias("n")))
    owner = {e[0]: e[4] for e in entries if e[1] == "subcategory" and e[4]}
    subs = lookup(pairs.select("value", "parent"), entries, "subcategory").join(F.broadcast(small(owner, "entry bigint, home bigint")), "entry", "left")
    subs = confirmed(subs, pairs.select("value", F.col("parent").alias("hint"), "n")).withColumnRenamed("entry", "sub_entry")
    rows = attach(rows, subs.select(F.col("value").alias("subcategory"), F.col("parent").alias("light"), "sub_entry"), ["subcategory", "light"])
    out = rows.select(
        F.col("id").alias("question_id"),
        F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value"), F.col(e).cast("long").alias("entry_id")) for f, e in (("category", "cat_entry"), ("subcategory", "sub_entry"), ("category_slug", "slug_entry"))))).alias("r"),
    ).select("question_id", "r.*").where("value is not null")
    own = questions.sparkSession.createDataFrame([(e[0], e[2], e[3]) for e in entries], "entry_id bigint, name string, slug string")
    out = out.join(F.broadcast(own), "entry_id", "left")
    same = F.when(F.col("field_name") == "category_slug", F.col("slug")).otherwise(F.col("name")) == F.col("value")
    return out.where(~F.coalesce(same, F.lit(False))).select("question_id", "field_name", "entry_id").distinct()
