"""Sentence boundaries by a hidden-event n-gram language model.

Between the words of a text stand hidden events: a boundary token or nothing. An event may stand where a terminal mark
(with the closing marks and tags behind it) has been read, and in scripts written without marks (Thai, Lao, Khmer,
Burmese) at white space. What stands inside paired quotation marks, title marks, brackets or parentheses holds no
event. A trigram model over the words, marks and boundary tokens gives both readings of each place their probability,
the forward-backward algorithm the posterior, and places with a posterior of one half or more are boundaries, whatever
their form leads one to expect.

The model is trained on the texts themselves, all of them: a first pass counts only places whose reading is certain from
their form (``first_guess``), each further pass those that the model of the pass before decides. Words outside the
vocabulary are replaced by their shape. A vocabulary word has at least ``MIN_SHARE`` of all words, an n-gram of the
model ``MIN_GRAM_SHARE`` of all n-grams, so the model that is sent to the workers has at most 1 / share entries of each
order, however large the corpus.

Defined results: null, empty and blank texts have no sentences; spans are code points, end-exclusive, without outer
white space, and cover everything else; a text without any mark is one sentence; repeated rows give the same spans
once (``spans``); an empty table gives none; marks that are never closed protect nothing; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.session import spread

MIN_SHARE = 1e-4
MIN_GRAM_SHARE = 2e-6
PASSES = 2
STRENGTH = 2.0
EVENT = "<s>"

#: Abbreviations (lower case, without the last dot) that a name, number or further word completes.
LEADING = frozenset(
    """dr st mt ft gen capt rev op no nos vs v c ca cf mr mrs ms prof col lt sgt cmdr adm gov sen rep pres hon fr br sr
    sra dra srta d dña núm art vol pp fig ed eds bzw nr hr frl hl z p pág págs m mm mme mlle mgr me ste chap e i s.a
    ggf vgl sog ο κ κα αρ π σελ д ул г им डॉ श्री د م أ ดร approx ch sect dept univ""".split()
) - {"no", "c", "e", "i", "p", "m", "d", "z", "v", "me", "art", "col", "br"} | {"e.g", "i.e", "z.b", "p.ej", "π.χ", "d.h", "u.a", "o.ä", "c.-à-d", "n.b"}
#: Those of them that are also words or letters; they lead only in the form that is checked in ``kind``.
LEADING_TOO = frozenset("no c v p d z m op art col ej b h ca".split())
#: Abbreviations that may end a sentence.
CLOSING = frozenset("u.s u.k u.n ph.d m.d b.a m.a jr sr co corp inc ltd al etc a.m p.m b.c a.d b.c.e c.e d.c usw km kg cm mm χλμ किमी bros s st ave blvd w.r.t esp".split())
#: German words before an ordinal.
BEFORE_ORDINAL = frozenset("am im vom zum der die das dem den des ab bis seit und beim ins".split())

_PAIRS = {"„": "“”", "“": "”", "‚": "‘’", "«": "»", "「": "」", "『": "』", "《": "》", "〈": "〉", "(": ")", "（": "）", "[": "]", "【": "】", '"': '"', "＂": "＂"}
_OPENERS = {e: [o for o, es in _PAIRS.items() if e in es] for es in _PAIRS.values() for e in es}
_CLOSERS = frozenset("”’»」』》〉)）]】\"＂“‘'")
_TERMINAL = ".!?…。！？｡؟۔।॥;;։።"
_UNSPACED = re.compile("[฀-໿က-႟ក-៿]")
_GREEK = re.compile("[Ͱ-Ͽἀ-῿]")
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_TOKEN = re.compile(r"(?P<tag></?[A-Za-z][^<>]*>)|(?P<num>\d+(?:[.,:]\d+)*)|(?P<abbr>(?:[^\W\d_]\.){2,}(?=[^\W\d_]?)|[^\W\d_]{1,2}\.[^\W\d_](?=\.))|(?P<mark>[.!?…。！？｡؟۔।॥;;։።]+)|(?P<word>[^\W\d_](?:[^\W\d_]|[̀-ͯऀ-ॣั-๎ً-ْ]|(?<=[^\W\d_])['’-](?=[^\W\d_]))*)|(?P<space>\s+)|(?P<other>.)", re.S)
_CJK = re.compile("[぀-ヿ㐀-鿿]")


_MARKS = re.compile("[" + re.escape("".join(_PAIRS) + "".join(_PAIRS.values())) + "]")
_LEAD = re.compile(r"\s*<em>(.*?)</em>\.?", re.S)
_BLANK = re.compile(r"\s*")


def protected(text: str) -> tuple[bytearray, dict[int, int]]:
    """Which characters stand inside a pair of marks, and for each closing mark its opening one."""
    inside, partner, stack, last = bytearray(len(text)), {}, [], {}
    at: dict[str, list[int]] = {}  # the places in the stack of each opening mark
    for m in _MARKS.finditer(text):
        i, c = m.start(), m[0]
        k = max((at[o][-1] for o in _OPENERS.get(c, "") if at.get(o)), default=None)
        if k is not None:
            o = stack[k][1]
            for x, _ in stack[k:]:
                at[x].pop()
            del stack[k:]
            partner[i] = o
            inside[o + 1 : i] = b"\x01" * (i - o - 1)
            continue
        for e in _PAIRS.get(c, ""):
            if e not in last:
                last[e] = text.rfind(e)
            if last[e] > i:
                at.setdefault(c, []).append(len(stack))
                stack.append((c, i))
                break
    return inside, partner


class Text:
    """Tokens and places of one text."""

    __slots__ = ("end", "places", "text", "tokens")

    def __init__(self, text: str):
        self.text, self.tokens, self.places = text, [], []
        inside, partner = protected(text)
        n, start = len(text), 0
        m = _LEAD.match(text)
        if m and (re.search(r"[.!?:]\s*$", m[1]) or m[0].endswith(".") or re.match(r"\s*[A-Z\"(]", text[m.end() : m.end() + 40])):
            start = m.end()
            self.places.append({"at": -1, "end": start, "guess": 1, "fixed": 1, "sure": True, "quote": None})
        toks = self.tokens
        for t in _TOKEN.finditer(text, start):
            kind, s, e = t.lastgroup, t.start(), t.end()
            if kind == "tag":
                continue
            if kind == "space":
                if not inside[s] and 0 < s and e < n and _UNSPACED.search(text[s - 1] + text[e]):
                    digit = text[s - 1].isdigit() or text[e].isdigit()
                    toks.append(("␣", s, e))
                    if not digit:
                        self.places.append({"at": len(toks) - 1, "end": s, "guess": 1, "fixed": None, "sure": True, "quote": None})
                continue
            if kind == "word" and _CJK.match(t[0]):
                toks += [(c, s + k, s + k + 1) for k, c in enumerate(t[0])]
                continue
            toks.append((t[0], s, e))
            if kind in ("mark", "abbr"):
                self._place(t, inside, partner)
        self.end = n

    def _place(self, t: re.Match, inside: bytearray, partner: dict[int, int]) -> None:
        text, n, s, e = self.text, len(self.text), t.start(), t.end()
        mark = t[0]
        if t.lastgroup == "abbr" and not mark.endswith("."):
            return
        if all(c == ";" for c in mark) and not (s and _GREEK.match(text[s - 1] if not text[s - 1].isspace() else text[s - 2 : s - 1] or " ")):
            return
        quote, p = None, e
        while p < n:  # closing marks and tags belong to the sentence
            if p in partner:
                quote = partner[p] if text[p] not in ")）]】" else quote
                p += 1
            elif (g := _TAG.match(text, p)) and g[0][1] == "/":
                p = g.end()
            elif text[p] in _TERMINAL and p > e and text[p] != ";":
                p += 1
            elif quote is None and text[p : p + 1].isspace() and (q := _BLANK.match(text, p).end()) in partner and text[q] == "»" and not inside[partner[q]]:
                quote, p = partner[q], q + 1
            else:
                break
        if p >= n or inside[min(p, n - 1)] or (p == e and inside[s]):
            return
        if self.places and self.places[-1]["end"] >= p:
            return
        nxt = text[p]
        if not nxt.isspace() and (nxt in ",;:،؛、，·/-–—" or nxt in _CLOSERS and nxt not in _PAIRS):
            return
        q = _BLANK.match(text, p).end()
        rest = text[q : q + 80]
        if not rest or rest[0] in ",;:،؛、，)]":
            return
        spaced = nxt.isspace()
        if quote is not None and not spaced and _CJK.match(nxt):  # a title or quotation that the sentence runs on from
            return
        if not spaced and t.lastgroup == "mark" and mark == "." and p == e and (re.search(r"(?:^|[\W\d_])[^\W\d_]$|Ph$", text[max(0, s - 3) : s]) or nxt.isdigit() and text[s - 1 : s].isdigit()):
            return
        self.places.append({"at": len(self.tokens) - 1, "end": p, "fixed": None, "sure": True, "quote": quote, **self._form(mark, t.lastgroup, s, rest, spaced)})

    def _form(self, mark: str, kind: str, s: int, rest: str, spaced: bool) -> dict:
        """The first guess of a place (1, 0, None) and whether it is fixed."""
        word = "" if kind == "abbr" else (self.tokens[-2][0] if len(self.tokens) > 1 and self.tokens[-2][2] == s else "")
        if kind == "abbr":
            low = mark[:-1].lower()
        else:
            low = word.lower()
            if len(self.tokens) > 2 and self.tokens[-2][2] == s and len(word) == 1 and re.fullmatch(r"[^\W\d_]\.", self.text[max(0, self.tokens[-2][1] - 2) : self.tokens[-2][1]]):
                low = self.text[self.tokens[-2][1] - 2] .lower() + "." + low
        r = re.sub(r"^(?:</?\w+[^<>]*>|[\"“„«‘'(\[¿¡「『《]|\s)+", "", rest) or " "
        upper, lower = r[0].isupper() or r[0].istitle(), r[0].islower()
        opened = rest[0] in "\"“„«¿¡「『《"
        name = kind == "mark" and mark == "."
        if mark[0] in "…" or mark.startswith(".."):
            return {"guess": 0 if lower or not spaced else (1 if upper else None)}
        if mark[0] in "。｡।॥！？۔":
            return {"guess": 1}
        if mark[-1] in "!?؟;;":
            # a title or quotation that the sentence runs on from, or a missing capital: a lean for the first pass only
            return {"guess": 0, "sure": False} if lower else {"guess": 1}
        if kind == "abbr" or name:
            if low in CLOSING:
                return {"guess": 0 if lower else None}
            if low in LEADING or low in LEADING_TOO:
                return {"guess": None if opened else 0}
            if len(word) == 1 and word.isalpha():
                return {"guess": 0 if upper or lower or r[0].isdigit() else None}
            if word.isdigit() and len(word) <= 2:
                before = self.tokens[-3][0].lower() if len(self.tokens) > 2 else ""
                return {"guess": 0 if before in BEFORE_ORDINAL or not before else (0 if lower else None)}
        if upper or opened or (spaced and not lower and not r[0].isdigit()):
            return {"guess": 1}
        return {"guess": None}


def shape(token: str, vocabulary) -> str:
    """What the model sees of a token."""
    if token in (EVENT, "␣"):
        return token
    c = token[0]
    if c.isdigit():
        return f"#{min(len(token), 5)}" if token.isdigit() else "#.#"
    if not c.isalpha():
        return "..." if token.startswith(("..", "…")) else c
    low = token.lower()
    if len(token) > 1 and low.rstrip(".") in LEADING:
        return "<leading>"
    if low in vocabulary:
        return low
    if len(token) == 1 and c.isupper():
        return "<initial>"
    return "<Name>" if c.isupper() else "<word>" if c.islower() else f"<{unicodedata.name(c, 'other').split()[0].lower()}>"


def windows(t: Text, vocabulary, decided: list[int | None]) -> Iterator[tuple[str, str, str]]:
    """(history 1, history 2, token) n-grams at the decided places, with the boundary token where it stands."""
    seq = [shape(x[0], vocabulary) for x in t.tokens]
    for place, d in zip(t.places, decided):
        k = place["at"]
        if d is None or k < 0:
            continue
        u, v = (seq[k - 1] if k else EVENT), seq[k]
        w = seq[k + 1] if k + 1 < len(seq) else EVENT
        x = seq[k + 2] if k + 2 < len(seq) else EVENT
        if d:
            yield (u, v, EVENT)
            yield (v, EVENT, w)
            yield (EVENT, w, x)
        else:
            yield (u, v, "<no>")
            yield (u, v, w)
            yield (v, w, x)


class Model:
    """Trigrams with their lower orders, each backed off to the next by a Dirichlet prior of STRENGTH."""

    def __init__(self, vocabulary: frozenset, grams: dict[tuple[str, ...], int]):
        self.vocabulary, self.c = vocabulary, grams
        self.total = sum(n for g, n in grams.items() if len(g) == 1) or 1
        self.sums: Counter = Counter()
        for g, n in grams.items():
            if len(g) > 1 and g[-1] not in ("<no>", EVENT):
                self.sums[g[:-1]] += n

    def word(self, u: str, v: str, w: str) -> float:
        c = self.c
        p = (c.get((w,), 0) + 0.5) / (self.total + 5e3)
        p = (c.get((v, w), 0) + STRENGTH * p) / (self.sums.get((v,), 0) + STRENGTH)
        return (c.get((u, v, w), 0) + STRENGTH * p) / (self.sums.get((u, v), 0) + STRENGTH)

    def event(self, u: str, v: str) -> float:
        c = self.c
        yes, no = c.get((v, EVENT), 0), c.get((v, "<no>"), 0)
        p = (yes + 1) / (yes + no + 2)
        yes, no = c.get((u, v, EVENT), 0), c.get((u, v, "<no>"), 0)
        return (yes + STRENGTH * p) / (yes + no + STRENGTH)

    def posteriors(self, t: Text) -> list[float]:
        """Forward-backward over the places; places more than two words apart don't see each other."""
        out = [float(p["fixed"] or 0) for p in t.places]
        if not t.places:
            return out
        seq = [shape(x[0], self.vocabulary) for x in t.tokens]
        at = {p["at"]: i for i, p in enumerate(t.places) if p["at"] >= 0}
        ks = sorted(at)
        i = 0
        while i < len(ks):
            j = i
            while j + 1 < len(ks) and ks[j + 1] - ks[j] <= 2:
                j += 1
            self._cluster(seq, ks[i : j + 1], at, out)
            i = j + 1
        return out

    def _cluster(self, seq, ks, at, out) -> None:
        first, last = ks[0], min(ks[-1] + 2, len(seq) - 1)
        own = set(ks)
        # state: words since the boundary (0, 1, 2 for more), before token i
        steps = []  # per token: list of (state, next state, fired, probability)
        for i in range(first, last + 1):
            moves = []
            for d in (0, 1, 2) if i > first else (2,):
                b1 = seq[i - 1] if i else EVENT
                b2 = seq[i - 2] if i > 1 else EVENT
                u, v = ((b1, EVENT) if d == 0 else (EVENT, b1) if d == 1 else (b2, b1))
                p = self.word(u, v, seq[i]) if i > first else 1.0
                to = min(d + 1, 2)
                if i in own:
                    e = self.event(v if v != EVENT or d == 0 else EVENT, seq[i])
                    moves.append((d, 0, True, p * e))
                    moves.append((d, to, False, p * (1 - e)))
                else:
                    moves.append((d, to, False, p))
            steps.append((i, moves))
        alpha = [{2: 1.0}]
        for _, moves in steps:
            nxt: dict[int, float] = {}
            for d, to, _, p in moves:
                if d in alpha[-1]:
                    nxt[to] = nxt.get(to, 0.0) + alpha[-1][d] * p
            z = sum(nxt.values()) or 1.0
            alpha.append({k: x / z for k, x in nxt.items()})
        beta = {0: 1.0, 1: 1.0, 2: 1.0}
        for (i, moves), a in zip(reversed(steps), reversed(alpha[:-1])):
            yes = no = 0.0
            new: dict[int, float] = {}
            for d, to, fired, p in moves:
                m = p * beta.get(to, 0.0)
                new[d] = new.get(d, 0.0) + m
                if fired:
                    yes += a.get(d, 0.0) * m
                else:
                    no += a.get(d, 0.0) * m
            if i in own:
                out[at[i]] = yes / (yes + no) if yes + no else 0.0
            z = sum(new.values()) or 1.0
            beta = {k: x / z for k, x in new.items()}

    def decide(self, t: Text) -> list[int]:
        """1 for a boundary. A quotation that opens a sentence goes on with what follows it."""
        out, start = [], 0
        for place, p in zip(t.places, self.posteriors(t)):
            yes = int(p >= 0.5)
            q = place["quote"]
            if yes and q is not None and _BLANK.match(t.text, start, q).end() == q:
                yes = 0
            if yes:
                start = place["end"]
            out.append(yes)
        return out


def trimmed(text: str, cuts: list[int]) -> list[tuple[int, int]]:
    """The spans between the cuts, without outer white space."""
    out, a = [], 0
    for b in [*cuts, len(text)]:
        s = text[a:b]
        left = len(s) - len(s.lstrip())
        right = len(s.rstrip())
        if right > left:
            out.append((a + left, a + right))
        a = b
    return out


def split(text: str, model: Model) -> list[tuple[int, int]]:
    t = Text(text)
    return trimmed(text, [p["end"] for p, d in zip(t.places, model.decide(t)) if d])


def _texts(rows: DataFrame, text_col: str) -> DataFrame:
    return spread(rows.select(F.col(text_col).alias("text")).where("text is not null and trim(text) <> ''"))


def vocabulary(rows: DataFrame, text_col: str) -> frozenset:
    """Words with at least MIN_SHARE of all words; at most 1 / MIN_SHARE of them, so they fit the driver at any size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for b in batches:
            for text in b.text:
                counts.update(m[0].lower() for m in _TOKEN.finditer(text) if m.lastgroup in ("word", "abbr") and not _CJK.match(m[0]))
            if len(counts) > 200_000:
                yield pd.DataFrame({"w": list(counts), "n": list(counts.values())})
                counts = Counter()
        yield pd.DataFrame({"w": list(counts), "n": list(counts.values())}).astype({"w": "object", "n": "int64"})

    words = _texts(rows, text_col).mapInPandas(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n")).first()[0] or 0
    return frozenset(r.w for r in words.where(F.col("n") >= MIN_SHARE * total).where("n > 2").collect())


def train(rows: DataFrame, text_col: str = "text", passes: int = PASSES) -> Model:
    """The model of all texts."""
    spark = rows.sparkSession
    words = vocabulary(rows, text_col)
    model = None
    for _ in range(passes):
        shared = spark.sparkContext.broadcast((words, model))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            vocab, last = shared.value
            counts: Counter = Counter()

            def flush() -> pd.DataFrame:
                return pd.DataFrame({"gram": ["\t".join(g) for g in counts], "n": list(counts.values())}).astype({"gram": "object", "n": "int64"})

            for b in batches:
                for text in b.text:
                    t = Text(text)
                    decided = [p["guess"] for p in t.places] if last is None else last.decide(t)
                    counts.update(windows(t, vocab, decided))
                if len(counts) > 200_000:
                    yield flush()
                    counts = Counter()
            yield flush()

        grams = _texts(rows, text_col).mapInPandas(run, "gram string, n long")
        parts = F.split("gram", "\t")
        orders = F.array(F.col("gram"), F.array_join(F.slice(parts, 2, 2), "\t"), F.element_at(parts, 3))
        summed = grams.select(F.explode(orders).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
        total = summed.where(~F.contains("gram", F.lit("\t"))).agg(F.sum("n")).first()[0] or 0
        kept = summed.where(F.col("n") >= MIN_GRAM_SHARE * total).collect()
        model = Model(words, {tuple(r.gram.split("\t")): r.n for r in kept})
    return model


def spans(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, start_pos, end_pos of every sentence of every text that is not blank."""
    shared = rows.sparkSession.sparkContext.broadcast(train(rows, text_col))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for b in batches:
            out = [(i, s, e) for i, text in zip(b.id, b.text) for s, e in split(text, model)]
            yield pd.DataFrame(out, columns=["id", "start_pos", "end_pos"]).astype("int64")

    return spread(rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")).mapInPandas(run, "id long, start_pos long, end_pos long").distinct()
