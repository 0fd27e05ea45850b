"""The operators on small tables: nulls, blanks, repeats, ties, empty tables, clashing column names."""

import pytest
from pyspark.sql import functions as F

from quizlake.llm import abuse, canonical, leakage, names, neardup, packing, sentences


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


REF = [(1, "category", "History", "history", None), (2, "subcategory", "World History", "world-history", 1), (3, "category", "Literature", "literature", None), (4, "subcategory", "World Literature", "world-literature", 3)]
REF_SCHEMA = "entry_id bigint, entry_kind string, name string, slug string, parent_id bigint"
Q_SCHEMA = "id bigint, category string, category_slug string, subcategory string, value string, entry string"


def test_mapping(spark):
    rows = [
        (1, "History", "history", "World History", "x", "y"), (2, "hsitory", "history", "World", None, None), (3, "Lit.", None, "World", None, None),
        (4, None, "", " ", None, None), (5, "Heraldry", "literatur", "World Literatrue", None, None), (5, "Heraldry", "literatur", "World Literatrue", None, None), (6, "History " * 2000, None, None, None, None),
    ]
    out = {(q, f): e for q, f, e in got(canonical.map_questions(spark.createDataFrame(rows, Q_SCHEMA), spark.createDataFrame(REF, REF_SCHEMA))) if q != 6}
    assert out == {(2, "category"): 1, (2, "subcategory"): 2, (3, "category"): 3, (3, "subcategory"): 4, (5, "category"): 0, (5, "category_slug"): 3, (5, "subcategory"): 4}
    nothing = spark.createDataFrame([], REF_SCHEMA)
    assert got(canonical.map_questions(spark.createDataFrame(rows[:1], Q_SCHEMA), nothing)) == [(1, "category", 0), (1, "category_slug", 0), (1, "subcategory", 0)]
    assert canonical.map_questions(spark.createDataFrame([], Q_SCHEMA), spark.createDataFrame(REF, REF_SCHEMA)).count() == 0


def test_sentences(spark):
    base = "The mill stands. Dr. Who left by 3 p.m. yesterday! It was sold to the U.S. Another one burned."
    rows = [(1, base, "x"), (1, base, "x"), (2, None, "x"), (3, "  \n", "x"), (4, "no mark", "x"), (5, "", "x"), (6, "「来ない。」と書いた。終わり。", "x"), (7, "แม่น้ำยาว 26.7 กิโลเมตร ไม่มีใครรู้", "x")]
    rows += [(100 + k, base, "x") for k in range(40)] + [(200 + k, "The mill fell. Another one burned. Nobody knew why.", "x") for k in range(40)]
    df = spark.createDataFrame(rows, "id bigint, q string, text string")
    texts = {r[0]: r[1] for r in rows}
    out: dict = {}
    for i, a, b in sorted(got(sentences.spans(df, "id", "q"))):
        out.setdefault(i, []).append(texts[i][a:b])
    assert out[1] == ["The mill stands.", "Dr. Who left by 3 p.m. yesterday!", "It was sold to the U.S.", "Another one burned."]
    assert out[4] == ["no mark"] and out[6] == ["「来ない。」と書いた。", "終わり。"] and out[7] == ["แม่น้ำยาว 26.7 กิโลเมตร", "ไม่มีใครรู้"]
    assert not out.keys() & {2, 3, 5}
    assert sentences.spans(df.limit(0), "id", "q").count() == 0


def brute_pairs(rows, t=neardup.THRESHOLD):
    import re

    sets = {}
    for i, x in rows:
        n = re.sub(r"[\W_]+", " ", re.sub("<[^>]*>", "", (x or "").lower())).strip()
        if n:
            sets[i] = {n[k : k + 5] for k in range(max(len(n) - 4, 1))}
    return [(a, b) for a in sorted(sets) for b in sorted(sets) if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t]


def test_near_duplicates(spark, monkeypatch):
    import random

    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(300)]
    rows = [(1, None), (2, ""), (3, "..."), (4, "ab"), (5, "AB!"), (6, "x" * 50_000)]
    for k in range(40):
        words = rng.choices(vocab, k=40)
        for v in range(rng.randrange(1, 5)):
            w = list(words)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(40)] = rng.choice(vocab)
            rows.append((100 + 10 * k + v, "<b>" + " ".join(w) + "</b>"))
    family = rng.choices(vocab, k=60)
    for v in range(60):
        w = list(family)
        w[v] = rng.choice(vocab)
        rows.append((1000 + v, " ".join(w)))
    df = spark.createDataFrame([(*r, 0) for r in [*rows, rows[-1]]], "id bigint, t string, cell int")
    want = brute_pairs(rows)
    assert got(neardup.pairs(df, "id", "t")) == sorted(want, key=str)
    monkeypatch.setattr(neardup, "LEAF", 8)  # the path of hot cells
    assert got(neardup.pairs(df, "id", "t")) == sorted(want, key=str)
    assert neardup.pairs(df.limit(0), "id", "t").count() == 0


def test_no_pair_at_the_threshold_is_lost(spark):
    import random

    rng = random.Random(5)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))
    rows = []
    for k in range(1500):
        one = word(200)
        rows += [(2 * k, one), (2 * k + 1, one[:159] + word(41))]  # 155 of 237 substrings in common
    out = neardup.pairs(spark.createDataFrame(rows, "id bigint, t string"), "id", "t")
    assert got(out) == sorted([(2 * k, 2 * k + 1) for k in range(1500)], key=str)


T_SCHEMA, P_SCHEMA = "id bigint, name string, tournament_id bigint, form string", "id bigint, team_id bigint, name string, entity string"


def test_names(spark, monkeypatch):
    teams = [(1, "Balran Daugbauby Institute of Technology A", 1, "z"), (2, "Balran Daugauby Tech", 2, "z"), (3, "Balr. Daugbauby Inst. of Tech.", 3, "z"), (4, None, 4, "z"), (5, "Kemhish Lotkeane College", 1, "z"), (6, "Kemhish Lotkeane", 2, "z"), (7, "Balran Daugbauby Quiz Club", 3, "z"), (8, "123", 1, "z"), (9, "Kemhish Lotkeane", 5, "z")]
    players = [(1, 1, "Dmitri Brilberg", "z"), (2, 2, "D. Brilberg", "z"), (3, 3, "Brilberg, Dmitri", "z"), (4, 7, "Dmitri Brilberg*", "z"), (5, 4, "Dmitri Brilberg", "z"), (6, None, "Dmitri Brilberg", "z"), (7, 1, None, "z"), (8, 5, "Zoë Biryombe", "z"), (9, 6, "Zoe B.", "z"), (10, 6, "Chloë Biryombe", "z"), (11, 3, "Dmitri Brilberg", "z"), (12, 2, "", "z")]
    td, pd_ = spark.createDataFrame(teams, T_SCHEMA), spark.createDataFrame(players, P_SCHEMA)
    for edges in (names.LOCAL_EDGES, 0):  # the local clustering and the rounds
        monkeypatch.setattr(names, "LOCAL_EDGES", edges)
        t, p = names.entities(td, pd_)
        assert got(names.pairs(t)) == sorted([(1, 2), (1, 3), (2, 3), (5, 6), (5, 9)], key=str)
        assert got(names.pairs(p)) == sorted([(1, 2), (1, 3), (2, 3), (2, 11), (3, 11), (8, 9)], key=str)
    t, p = names.entities(td.limit(0), pd_)
    assert names.pairs(t).count() == 0 and names.pairs(p).count() == 0


def test_packing_round_trip(spark, monkeypatch):
    text = "Quiz text with ключ and 文学. " * 900
    rows = [(1, None, 1), (2, "", 1), (3, "   ", 1), (4, text, 1), (5, "short one", 1), (5, "short one", 1)] + [(100 + i, "word " * (i % 300 + 1), 1) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    monkeypatch.setattr(packing, "CHUNK_ITEMS", 100)
    out = packing.pack(packing.pieces(packing.token_counts(df)), chunk_items=100).collect()
    load: dict = {}
    for r in out:
        load[r.container_id] = load.get(r.container_id, 0) + r.n_tokens
    assert max(load.values()) <= packing.CAPACITY
    assert sorted(r.doc_id for r in out if r.doc_id != 4) == sorted([3, 5, 5, *range(100, 500)])
    enc = packing.encoding(packing.VOCABULARY)
    own = enc.encode_ordinary(text)
    parts = sorted((r.token_start, r.n_tokens) for r in out if r.doc_id == 4)
    assert enc.decode([t for a, n in parts for t in own[a : a + n]]) == text and all(n == packing.CAPACITY for _, n in parts[:-1])
    assert packing.containers(df.limit(0)).count() == 0


def test_leakage(spark, monkeypatch):
    item = " ".join(f"word{i}" for i in range(30))
    docs = [(1, f"Intro, {item.upper()}! Outro", "x"), (2, " ".join(item.split()[:11]) + " other", "x"), (3, None, "x"), (4, "", "x"), (5, "pad " * 5000 + " ".join(item.split()[7:19]), "x"), (5, "pad", "x")]
    items = [(10, item, "e"), (11, "z " + " ".join(item.split()[5:25]), "e"), (12, None, "e"), (13, "short", "e"), (10, item, "e")]
    dd, ii = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string"), spark.createDataFrame(items, "item_id bigint, text string, doc_id string")
    for bits in (leakage.BITS, 3):  # a bitmap that leaves most fingerprints out, and one that leaves none out
        monkeypatch.setattr(leakage, "BITS", bits)
        assert got(leakage.leaks(dd, ii)) == sorted([(1, 10), (1, 11), (5, 10), (5, 11)], key=str)
    assert leakage.leaks(dd, ii.limit(0)).count() == 0 and leakage.leaks(dd.limit(0), ii).count() == 0


def test_leakage_fetches_no_pair_for_k_grams_alone(spark, monkeypatch):
    """Each document shares 10 words with the item, so 5-grams and most likely a fingerprint; only document 0 shares 12."""
    item = [f"word{i}" for i in range(60)]
    docs = [(k, " ".join([f"a{k}x{i}" for i in range(9)] + item[k : k + (10 if k else 12)] + [f"b{k}x{i}" for i in range(9)])) for k in range(50)]
    kept, cut = [], leakage.cut
    monkeypatch.setattr(leakage, "cut", lambda df: kept.append(cut(df)) or kept[-1])
    found = leakage.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string"))
    assert got(found) == [(0, 7)] and got(kept[-1]) == [(0, 7)]


def test_scores(spark):
    docs = spark.createDataFrame([(1, "You worthless idiot, go kill yourself.", "f", "s"), (2, "A fine round.", "f", "s"), (3, None, "f", "s"), (4, "", None, "s"), (5, "A fine day. " * 5000 + "You idiot!", "g", "s")], "doc_id bigint, text string, source string, score string")
    labels = spark.createDataFrame([(1, 1, "a"), (1, 0, "b"), (1, 1, "c"), (2, 0, "a"), (9, 1, "a"), (2, None, "b"), (None, 1, "b")], "doc_id bigint, abusive int, text string")
    pairs = abuse.labelled(docs, labels)
    assert [(t[:6], y) for t, y in pairs] == [("You wo", pytest.approx(2 / 3)), ("A fine", 0.0)]
    out = {r.doc_id: r.score for r in abuse.scores(docs, abuse.fit(pairs), ["doc_id"]).collect()}
    assert out[1] > 0.5 > out[2] and out[3] == out[4] == 0.0 and out[5] > out[2]
    assert abuse.fit(abuse.labelled(docs.limit(0), labels)).score("You idiot, bitch") > 0
    assert abuse.scores(docs.limit(0), abuse.fit([]), ["doc_id"]).where(F.col("score") > 0).count() == 0


def test_one_more_row_does_not_flip_a_value(spark):
    """Rows of one kind say the same whether there are five of them or six, and only confirm or veto what the score accepts."""
    ref = spark.createDataFrame(REF, REF_SCHEMA)
    cols = [c.split()[0] for c in Q_SCHEMA.split(", ")]
    for n in (1, 5, 6, 7):
        rows = [tuple({"id": i, "category": "Hydrology", "category_slug": REF[0][3]}.get(c) for c in cols) for i in range(n)]
        out = {e for _, f, e in got(canonical.map_questions(spark.createDataFrame(rows, Q_SCHEMA), ref)) if f == "category"}
        assert out == {0}, n


def test_rows_veto_a_name_that_only_looks_like_a_listed_one(spark):
    """Its spelling alone says History; rows that name another category say that it is not."""
    ref = spark.createDataFrame(REF, REF_SCHEMA)
    for slug, want in (("literature", 0), ("history", 1)):
        rows = [(i, "Histology", slug, None, None, None) for i in range(3)]
        out = {e for _, f, e in got(canonical.map_questions(spark.createDataFrame(rows, Q_SCHEMA), ref)) if f == "category"}
        assert out == {want}, slug
