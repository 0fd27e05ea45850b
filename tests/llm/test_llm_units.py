"""The operators' plain functions against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quizlake.llm import abuse, canonical, leakage, names, neardup, packing, sentences


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 2048), max_size=300))
def test_packing_fills_every_item_once_within_capacity(sizes):
    bins = packing.harmonic(np.array(sizes, dtype=np.int64))
    load = np.bincount(bins, weights=sizes) if sizes else np.zeros(0)
    assert len(bins) == len(sizes) and (bins >= 0).all() and (load <= 2048).all() and (load > 0).all()


def test_packing_wastes_little():
    rng = np.random.default_rng(1)
    sizes = np.minimum(rng.lognormal(5, 1, 16000).astype(int) + 1, 2048)
    assert sizes.sum() / (packing.harmonic(sizes).max() + 1) / 2048 > 0.98


WORDS = [f"w{i}" for i in range(6)] + ["Éa", "<b>x</b>", "3"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=40), st.lists(st.sampled_from(WORDS), max_size=40), st.integers(0, 20))
def test_leakage_equals_brute_force(a, b, n):
    b = b + a[n : n + 14]
    x, y = " ".join(a), ", ".join(b)
    p, q = leakage.words(x), leakage.words(y)
    runs = {tuple(p[i : i + 12]) for i in range(len(p) - 11)} & {tuple(q[i : i + 12]) for i in range(len(q) - 11)}
    h = leakage._Hashes()
    got = [(2, 7)] if leakage.share(leakage.Side(x, h), leakage.Side(y, h)) else []
    if got:  # a shared span always shares a fingerprint
        assert len(np.intersect1d(leakage.prints(x, h), leakage.prints(y, h)))
    assert got == ([(2, 7)] if runs else [])


def test_words():
    assert leakage.words("<em>Été</em>-LE 2nd naïve_x") == ["ete", "le", "2nd", "naive", "x"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=30), min_size=2, max_size=30))
def test_tree_search_drops_no_similar_pair(sets):
    hashes = [np.array([(x * 0x9E3779B97F4A7C15) % 2**64 for x in sorted(s)], dtype=np.uint64) for s in sets]
    n, p = np.array([len(h) for h in hashes]), np.array([neardup.counts(h) for h in hashes])
    s = np.array([[len(h) % 5, len(h) - len(h) % 5] for h in hashes])
    fan = neardup.FAN
    neardup.FAN = 4
    leaf = lambda k: neardup.Leaf(n[k], p[k], s[k])
    got = set(neardup.search(leaf(slice(None))))
    got |= {(b, a) for a, b in got}
    half = len(sets) // 2
    across = set(neardup.search(leaf(slice(half)), leaf(slice(half, None)))) if half else set()
    neardup.FAN = fan
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= neardup.THRESHOLD:
                assert (i, j) in got
                if i < half <= j:
                    assert (i, j - half) in across


def test_capped_counts_stay_a_bound():
    a = np.full((1, neardup.GROUPS), 65535, dtype=np.uint16)
    assert neardup.bound(a, a)[0, 0] > 10**12


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab .!?\"«»()。」「<em>/\n ก1…;'"), max_size=80))
def test_sentence_spans_cover_the_text(text):
    model = sentences.Model(frozenset(), {})
    spans = sentences.split(text, model)
    assert all(0 <= a < b <= len(text) and not text[a].isspace() and not text[b - 1].isspace() for a, b in spans)
    assert all(p[1] <= q[0] for p, q in zip(spans, spans[1:]))
    assert "".join(text[a:b] for a, b in spans).replace(" ", "").split() == "".join(text.split()).replace(" ", "").split() or "".join("".join(text[a:b].split()) for a, b in spans) == "".join(text.split())


def test_long_texts_take_linear_time():
    model = sentences.Model(frozenset(), {})
    assert len(sentences.split('He said "go. ' * 20_000, model)) > 0
    assert sentences.split("(" * 50_000 + "a. B", model)
    assert abuse.Model({"idiot": 5.0}, -3.0).score("a b c. " * 50_000) < 0.05  # what the bias gives


def test_forms_of_typed_values():
    entries = [(1, "category", "History", "history", None), (2, "category", "Fine Arts", "fine-arts", None), (3, "subcategory", "World History", "world-history", 1), (4, "subcategory", "World Literature", "world-literature", 5)]
    index = canonical.Index(canonical.forms(entries, "category"))
    sub = canonical.Index(canonical.forms(entries, "subcategory"))
    for v, e in (("Hsitory", 1), ("*History (3)", 1), ("FineArts", 2), ("cat-fine-arts-2", 2), ("???", 0), ("History - World History", 1), ("Hıstory", 1), ("past", 1)):
        assert canonical.decide(v, "category", index)[0] == e, v
    assert canonical.decide("World", "subcategory", sub, 1)[0] == 3 and canonical.decide("World", "subcategory", sub, 5)[0] == 4
    assert canonical.decide("x", "category", canonical.Index([])) == (0, 0.0, 0.0)
    assert canonical.edits("abcd", "abdc") == 1 and canonical.edits("", "ab") == 2


def test_names():
    assert names.team("The Balran-Daugbauby Inst. of Tech. (B)") == ("balran daugbauby", "institute of technology")
    assert names.team("Uni Balran Daugbauby 2")[1] == "university" and names.team("Balran Daugbauby") == ("balran daugbauby", "")
    assert names.person("Vautquist, Charlotte (C)*") == "charlotte vautquist" and names.person("Édith L. Kikstead") == "edith kikstead"
    s = names.person_similarity
    for a, b in (("d brilberg", "dmitri brilberg"), ("zoe b", "zoe biryombe"), ("payneziak leonard", "lenny payneziak"), ("bob pulgard", "robert pulgrad")):
        assert s(a, b, 0.5) > 0.5, (a, b)
    for a, b in (("dmitri brilberg", "deborah brilberg"), ("zoe biryombe", "chloe biryombe"), ("ines dal", "ines kor")):
        assert s(a, b, 0.5) == 0.0, (a, b)
    assert names.person("") == "" and names.team("  ") == ("", "")


def test_local_linkage_equals_greedy():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(2, 9)
        edges = [(i, j, round(rng.random(), 3)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.7]
        sims = {(a, b): s for a, b, s in edges}
        groups = [[i] for i in sorted({x for e in edges for x in e[:2]})]
        mean = lambda g, h: sum(sims.get((min(a, b), max(a, b)), 0.0) for a in g for b in h) / (len(g) * len(h))
        while True:
            best = max(((mean(g, h), -i, -j) for i, g in enumerate(groups) for j, h in enumerate(groups) if i < j), default=(0, 0, 0))
            if best[0] < 0.5:
                break
            groups[-best[1]] += groups.pop(-best[2])
        out: dict = {}
        for node, c in names._linked(edges, 0.5):
            out.setdefault(c, set()).add(node)
        assert sorted(map(sorted, out.values())) == sorted(map(sorted, groups))


@pytest.mark.parametrize(("raw", "plain"), [("k i l l", "kill"), ("dip$h17", "dipshit"), ("nakеd", "naked"), ("orrrrgasm", "orgasm"), ("xxx", "xxx"), ("18+ at 3am", "18+ at 3am")])
def test_disguises(raw, plain):
    assert abuse.plain(raw) == plain


def test_classifier_learns_from_noisy_documents():
    rng = random.Random(3)
    calm = ["The round was long.", "We played on a coastal buzzer.", "Women are welcome in every round.", "The packet mentions an insult, a clue."]
    rude = ["You are a zorgish clown.", "Women are zorgish trash."]

    def doc(bad):
        s = rng.choices(calm, k=6) + ([rng.choice(rude)] if bad else [])
        rng.shuffle(s)
        return " ".join(s)

    data = [(doc(k % 3 == 0), float(k % 3 == 0)) for k in range(240)]
    noisy = [(t, y if rng.random() > 0.06 else 1 - y) for t, y in data]
    model = abuse.fit(noisy)
    held = [(doc(k % 2 == 0), k % 2 == 0) for k in range(200)]
    assert sum((model.score(t) >= 0.5) == y for t, y in held) >= 190
    assert abs(model.one.get("women", 0.0) - model.one.get("muslims", 0.0)) < 0.6
    assert model.score("") == 0.0
    assert abuse.fit([]).score("You idiot, you stupid bitch") > abuse.fit([]).score("Good day")


def test_every_sentence_counts_by_its_bigrams_too():
    """Words that say nothing alone still count together."""
    m = abuse.Model({"go back": 6.0, "back home": 4.0, "calm": -1.0}, -3.0)
    assert m.score("A calm day. You go back home!") > 0.99
    assert m.score("Go. Back. Home.") < 0.1


def test_groups_stand_in_for_names():
    ws = abuse.words("All Zorbians are vermin and Zorbians stink")
    assert "<n>" in ws
    swapped = abuse.swapped(ws, 0)
    assert "<n>" not in swapped and len(swapped) == len(ws) and not abuse._IDENTITY.isdisjoint(swapped)
    assert abuse.swapped(["women", "win"], 0)[0] in abuse._IDENTITY - {"women"}


def test_marks_and_tags_of_any_depth_and_length():
    deep = "He " + "(" * 30 + "a. B" + ")" * 30 + " left. Then it ended."
    model = sentences.Model(frozenset(), {})
    assert not any(deep[:e].count("(") > deep[:e].count(")") for _, e in sentences.split(deep, model))
    tag = '<a href="' + "x" * 200 + '. Y">'
    t = sentences.Text(f"One {tag}two. Three four.")
    assert all(p["end"] > len(tag) for p in t.places)


def test_whole_strings_are_compared():
    long = "x" * 80
    assert names.team_similarity(long + "abcdefgh", long + "abcdefgi", 0.5) < 1.0
    assert canonical.edits(long + "ab", long + "cd") == 2


def test_an_entry_beyond_the_nearest_forty_eight_is_still_found():
    """Sixty forms of a higher cosine than the right one's would have hidden it before."""
    entries = [(i, "category", f"zebra{i:02d}{'zebra' * 6}", f"s{i}", None) for i in range(1, 61)] + [(99, "category", "zebra", "zebra", None)]
    index = canonical.Index(canonical.forms(entries, "category"))
    assert canonical.decide("zebr", "category", index)[0] == 99


def test_pieces_meet_whatever_their_size_and_send_only_scored_pairs(spark, monkeypatch):
    """Every pair of a block, and none across blocks, has its cosine; no posting meets another in a shuffle."""
    rng = np.random.default_rng(3)
    forms = sorted({"".join(rng.choice(list("abcde"), 5)) for _ in range(60)})
    nodes = [(1000 * b + k, b, f) for b in (1, 2, 3) for k, f in enumerate(forms if b == 1 else forms[: 6 * b])]
    df = spark.createDataFrame(nodes, "node long, block long, form string")
    weights: dict = {}
    for r in names.postings(df).collect():
        weights.setdefault((r.node, r.block), {})[r.gram] = r.w
    want = {}
    for (a, x), p in weights.items():
        for (b, y), q in weights.items():
            c = sum(w * q.get(g, 0) for g, w in p.items())
            if a < b and x == y and c >= 0.3:
                want[a, b] = round(c, 9)
    monkeypatch.setattr(names, "PIECE", 16)
    monkeypatch.setattr(names, "MEETINGS", 50)
    found = names.similar(df, lambda f, g, c: c)
    assert len(want) > 50 and {(r.a, r.b): round(r.s, 9) for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_leaves_meet_where_they_lie(spark, monkeypatch):
    """With a leaf for every few texts all pairs are still found, and no leaf is copied for the others in a shuffle."""
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 60))) for _ in range(12)]
    texts = sorted({b[:k] + rng.choice("xyz") + b[k:] for b in base for k in (3, 9, 15)} | set(base))
    df = spark.createDataFrame(list(enumerate(texts)), "rep long, norm string")
    sets = [{t[k : k + 5] for k in range(len(t) - 4)} for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= neardup.THRESHOLD}
    monkeypatch.setattr(neardup, "LEAF", 3)
    found = neardup.candidates(neardup.points(df).localCheckpoint())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    assert want and want <= {(r.a, r.b) for r in found.collect()}
