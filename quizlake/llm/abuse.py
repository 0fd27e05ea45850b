"""Scoring texts for abuse, hate and sexual explicitness with a counterfactually regularised classifier.

A text is abusive through one passage, so the classifier scores sentences and a document has the score of its worst one.
It is a sparse logistic model over word unigrams and bigrams after disguises are undone (other alphabets' look-alike
letters, digits for letters, letters set apart, stars). It is fitted on the labelled documents: their sentences'
labels are unknown, so each round takes, in a document labelled abusive, the sentence that scores highest as the
abusive one, and all of a document labelled harmless as harmless; documents whose label no sentence bears out (raters
err) are left aside in later rounds. The scores for this come from models fitted without the document.

Counterfactual regularisation: in every training sentence that names a group the group is swapped for others, in every one
with a name (of a person, place or group that no list knows) a group stands in for the name, and the squared change of the
score is part of the loss. So neither the name of a group nor its company gains weight of its own, and what is said of one
group counts for all.

Bounds: at most ``MAX_LABELLED`` labelled documents are used, those with the least hash of their id; the fitted model
keeps at most ``MAX_WEIGHTS`` weights. Every document is scored whole.

Defined results: null, empty and blank texts score 0; labels of ids without a text are ignored, several labels of one
document count with their mean, a null label not at all; without usable labels the prior weights alone decide;
repeated rows score alike; further columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.session import spread

MAX_LABELLED = 4_000
MAX_WEIGHTS = 50_000
THRESHOLD = 0.5
ROUNDS = 4
FOLDS = 3
EPOCHS = 25
RATE = 0.5
DECAY = 2e-4
COUNTERFACTUAL = 2.0
LEAST_WEIGHT = 0.02
SWAPS = 2
#: mean log ratio of shares in abusive and harmless documents from which a sentence is taken at first
EVIDENCE = 1.4

#: Names of groups of people that sentences are swapped between.
IDENTITIES = """women men girls boys gays lesbians muslims jews christians hindus buddhists atheists immigrants refugees foreigners blacks whites asians
arabs africans mexicans turks poles roma disabled elderly women's""".split()  # fmt: skip

#: Words that speak for abuse before any label is seen (prior weights, which the labels can undo; below 0 against it).
PRIOR = {
    2.0: """idiot moron imbecile dumbass asshole jackass dipshit bitch bastard wanker twat cunt whore slut scumbag retard retarded faggot nigger
    fucker motherfucker fuck fucking shithead leech worthless pathetic loser losers subhuman vermin parasites roaches cripples disgusting filthy
    stupid trash porn porno hardcore nude nudes naked topless horny escorts orgasms orgasm blowjob xxx fresse missgeburt ungeziefer arschloch hurensohn
    schlampe dreck verpiss wichser gueule ordure connard salope pute parasites basura puta mierda cabrón gilipollas mueras τσακίσου ηλίθιε""".split(),
    1.0: """kill die dies choke chokes bleed rope hang sex sexo sexual rot drown drowned infect breed rats ape apes animals stinks dirty dumb useless spineless
    hates hate hell scum shit piss explicit adults breasts uncensored yourself illiterate""".split(),
    # reporting, quoting, condemning and treating
    -1.0: """condemned slander historians removed banned reported quoted slur offensive policy harassment screening clinical medical
    statute law scholars essay biography""".split(),
}

#: Look-alikes of Latin letters in other alphabets, and signs that stand for letters within words.
LOOK_ALIKE = str.maketrans("аеорсухіјѕԁһкмтвнАЕОРСХІЈЅКМТВНοαενιρτυκχ", "aeopcyxijsdhkmtbhAEOPCXIJSKMTBHoaeviptukx")
SIGNS = str.maketrans("013457$@!|€8+", "oieastsaiiebt")

_SENTENCE = re.compile(r"(?<=[.!?।。！？])\s+|[\n\r]+|(?<=[。！？])")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W\d_]+)*")
_PREFIX = re.compile(r"^\s*(?:\[\d\d?:\d\d\]\s*\S+:|\d+\.)\s*|^\s+")
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ .\-_*][^\W\d_]){2,}(?![^\W_])")
_SIGNED = re.compile(r"[^\s\"“”«».,;:()]*(?:[A-Za-z][\d$@!|€*+]|[\d$@|€][A-Za-z])[^\s\"“”«».,;:()]*")
_STARS = re.compile(r"[A-Za-z]+(?:[*#]+[A-Za-z]+)+")
_LONG = re.compile(r"([A-WYZa-wyz])\1{2,}")
_RUNS = tuple(c * 3 for c in "abcdefghijklmnopqrstuvwxyz")
# signs and digits beside letters, single letters set apart, letters of two alphabets in one word, invisible characters
_ODD = re.compile(r"[$@|€*#]|\d(?:[A-Za-z]|(?<=[A-Za-z]\d))| [^\W\d_] [^\W\d_] |[.\-_][^\W\d_][.\-_][^\W\d_][.\-_]")
_ODD_WIDE = re.compile(r"[Ѐ-ӿͰ-Ͽ](?:[A-Za-z]|(?<=[A-Za-z][Ѐ-ӿͰ-Ͽ]))|[\u200b-\u200f\u2060-\u2064\u00ad\ufeff\uff00-\uffef]")
_HIDDEN = re.compile("[​-‏⁠-⁤­﻿]")
_VOWELS = re.compile(r"[aeiou*#]")


def disguised(text: str) -> bool:
    if _ODD.search(text) or (not text.isascii() and _ODD_WIDE.search(text)):
        return True
    low = text.lower()
    return any(r in low for r in _RUNS)


def plain(text: str) -> str:
    """The text with disguises undone."""
    if not disguised(text):
        return text
    text = unicodedata.normalize("NFKC", _HIDDEN.sub("", text))
    text = re.sub(r"[^\W\d_]*[A-Za-z][^\W\d_]*", lambda m: m[0] if m[0].isascii() else m[0].translate(LOOK_ALIKE), text)
    text = _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m[0]), text)
    text = _SIGNED.sub(lambda m: m[0].translate(SIGNS) if "*" not in m[0] and not re.fullmatch(r"\d+(?:st|nd|rd|th|s|am|pm|km|[A-Za-z])\W*", m[0]) else m[0], text)
    text = _LONG.sub(r"\1", text)
    return _STARS.sub(lambda m: f"{re.sub('[*#]', '', m[0])} sk{_VOWELS.sub('', m[0].lower())}", text)


def words(sentence: str) -> list[str]:
    """Lower-case words; names (capitals inside a sentence) and numbers as classes."""
    out = []
    for k, w in enumerate(_WORD.findall(sentence)):
        if w[0].isdigit():
            out.append("<#>")
        elif w.isupper() or not w[0].isupper():
            out.append(w.lower())
        else:
            low = w.lower()
            out.append(low if low in _IDENTITY or (k == 0 and len(w) < 8) else "<n>")
    return out


_IDENTITY = frozenset(IDENTITIES)
_PRIOR = {w: p for p, ws in PRIOR.items() for w in ws}
_PRIOR |= {f"sk{_VOWELS.sub('', w)}": p for w, p in _PRIOR.items() if p > 0 and w.isascii() and 3 <= len(w) <= 8}


def parts(text: str) -> list[str]:
    """The sentences, without what a log or list puts before them, disguises undone."""
    odd = disguised(text)
    return [_PREFIX.sub("", plain(x) if odd else x) for x in _SENTENCE.split(text) if x and not x.isspace()]


def sentences(text: str) -> Iterator[list[str]]:
    for part in parts(text):
        yield words(part)


def features(ws: list[str]) -> set[str]:
    out = set(ws)
    out.update(a + " " + b for a, b in zip(ws, ws[1:]))
    if not _IDENTITY.isdisjoint(ws):
        out.add("<group>")
    return out


def swapped(ws: list[str], k: int) -> list[str]:
    """The sentence with each group replaced by another one of the list, or, where it names none, its names by a group."""
    n = len(IDENTITIES)
    if _IDENTITY.isdisjoint(ws):
        group = IDENTITIES[zlib.crc32(f"{k} {' '.join(ws)}".encode()) % n]
        return [group if w == "<n>" else w for w in ws]
    return [IDENTITIES[(IDENTITIES.index(w) + 1 + (zlib.crc32(w.encode()) + 7 * k) % (n - 1)) % n] if w in _IDENTITY else w for w in ws]


class Model:
    """Weights by feature. Every sentence is scored, or passed over because its words could not lift it over the worst one."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.bias = bias
        self.one = {w: x for w, x in weights.items() if " " not in w}
        self.two: dict[str, dict[str, float]] = defaultdict(dict)
        for w, x in weights.items():
            if " " in w:
                a, b = w.split(" ")
                self.two[a][b] = x
        self.two = dict(self.two)
        # the most that a word can add: its own weight and that of the best bigram it opens. A capitalised word may stand as
        # itself or as a name, a number as its class
        most = {w: max(self.one.get(w, 0.0), 0.0) + max([0.0, *self.two.get(w, {}).values()]) for w in {*self.one, *self.two}}
        self.other = max(most.get("<n>", 0.0), most.get("<#>", 0.0))
        self.most = {w: max(x, self.other) for w, x in most.items()}
        self.top = bias + max(self.one.get("<group>", 0.0), 0.0)

    def margin(self, ws: list[str]) -> float:
        one, two, seen, total = self.one, self.two, set(), self.bias
        last = None
        for w in ws:
            if w not in seen:
                seen.add(w)
                total += one.get(w, 0.0)
            if last is not None and (t := two.get(last)) is not None and w in t and (last, w) not in seen:
                seen.add((last, w))
                total += t[w]
            last = w
        return total + (one.get("<group>", 0.0) if not _IDENTITY.isdisjoint(seen) else 0.0)

    def score(self, text: str) -> float:
        """Probability that the worst sentence is abusive."""
        worst, most, other = -30.0, self.most.get, repeat(self.other)
        for part in parts(text):
            if self.top + sum(map(most, _WORD.findall(part.lower()), other)) > worst:
                worst = max(worst, self.margin(words(part)))
        return 0.0 if worst <= -30 else float(1 / (1 + np.exp(-min(worst, 30.0))))


class _Sentences:
    """The training sentences as index arrays."""

    def __init__(self, docs: list[tuple[list[list[str]], float]]):
        self.common = Counter(f for s, _ in docs for ws in s for f in features(ws))
        vocab: dict[str, int] = {}
        for f in [f for f, n in self.common.items() if n > 1] + [*_PRIOR, *IDENTITIES, "<group>"]:
            vocab.setdefault(f, len(vocab))
        self.vocab, self.prior = vocab, np.zeros(len(vocab))
        for w, p in _PRIOR.items():
            self.prior[vocab[w]] = p
        rows, owner = [], []
        for d, (s, _) in enumerate(docs):
            for ws in s:
                rows.append(np.array(sorted(vocab[f] for f in features(ws) if f in vocab), dtype=np.int64))
                owner.append(d)
        self.n, self.owner, self.label = len(rows), np.array(owner, dtype=np.int64), np.array([y for _, y in docs])
        self.flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
        self.line = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        every = [ws for s, _ in docs for ws in s]
        # evidence of each sentence's bigrams from the labels of the other documents: mean log ratio of their shares
        held = [{f for ws in s for f in zip_words(ws)} for s, _ in docs]
        bad, good = (Counter(f for h, y in zip(held, self.label) if (y > 0.5) == k for f in h) for k in (True, False))
        n_bad, n_good = (self.label > 0.5).sum() + 1, (self.label < 0.5).sum() + 1

        def ratio(f: str, own: bool) -> float:
            return np.log((bad[f] - own + 0.3) / n_bad) - np.log((good[f] - (not own) + 0.3) / n_good)

        self.evidence = np.array([np.mean([ratio(f, self.label[d] > 0.5) for f in zip_words(ws)]) if len(ws) > 1 else 0.0 for ws, d in zip(every, self.owner)])
        # what comes and what goes when a sentence's groups are swapped
        line, flat, sign, self.swaps = [], [], [], 0
        for r, ws in zip(rows, every):
            named = not _IDENTITY.isdisjoint(ws)
            if not named and "<n>" not in ws:
                continue
            mine = set(r.tolist())
            for k in range(SWAPS if named else 1):
                for i in mine ^ {vocab[f] for f in features(swapped(ws, k)) if f in vocab}:
                    line.append(self.swaps)
                    flat.append(i)
                    sign.append(1.0 if i in mine else -1.0)
                self.swaps += 1
        self.cf_line, self.cf_flat, self.cf_sign = np.array(line, dtype=np.int64), np.array(flat, dtype=np.int64), np.array(sign)

    def margins(self, w: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.line, weights=w[self.flat], minlength=self.n) + bias

    def train(self, target: np.ndarray, w: np.ndarray, bias: float, epochs: int) -> tuple[np.ndarray, float]:
        """Logistic loss on the sentences with a target of 0 or 1, the prior's pull, and the counterfactual term."""
        use = target >= 0
        y = np.where(use, target, 0.0)
        n1, n0 = max((target > 0).sum(), 1), max((target == 0).sum(), 1)
        weight = np.where(use, np.where(target > 0, np.sqrt(n0 / n1), 1.0), 0.0)
        if not weight.any():
            return w, bias
        weight /= weight.sum()
        size = len(self.vocab)
        w, g2, gb2 = w.copy(), np.full(size, 1e-8), 1e-8
        for _ in range(epochs):
            e = weight * (1 / (1 + np.exp(-np.clip(self.margins(w, bias), -30, 30))) - y)
            g = np.bincount(self.flat, weights=e[self.line], minlength=size) + DECAY * (w - self.prior)
            if self.swaps:
                change = np.bincount(self.cf_line, weights=w[self.cf_flat] * self.cf_sign, minlength=self.swaps)
                g += COUNTERFACTUAL * np.bincount(self.cf_flat, weights=change[self.cf_line] * self.cf_sign, minlength=size) / self.swaps
            gb = e.sum()
            g2 += g * g
            gb2 += gb * gb
            w -= RATE * g / np.sqrt(g2)
            bias -= RATE * gb / np.sqrt(gb2)
        return w, bias


def fit(pairs: list[tuple[str, float]]) -> Model:
    """The model of (text, mean label) pairs. Sentences are chosen by models that have not seen their document."""
    docs = [([ws for ws in sentences(t) if ws], y) for t, y in pairs]
    docs = [(s, y) for s, y in docs if s and y != 0.5]
    x = _Sentences(docs)
    w, bias = x.prior.copy(), -3.0
    if not x.n or not (x.label > 0.5).any() or not (x.label < 0.5).any():
        return Model({f: float(x.prior[i]) for f, i in x.vocab.items() if x.prior[i]}, bias)
    yes = x.label[x.owner] > 0.5
    part = np.zeros(len(docs), dtype=np.int64)
    for k in (False, True):  # either label is dealt out evenly
        own = np.nonzero((x.label > 0.5) == k)[0]
        part[own] = np.arange(len(own)) % FOLDS
    fold = part[x.owner]
    spoken = x.margins(w, 0.0)
    margins = spoken + x.evidence
    heard = (spoken >= 1) | (x.evidence >= EVIDENCE)
    for step in range(ROUNDS):
        target = np.where(yes, -1.0, 0.0)
        order = np.lexsort((-margins, x.owner))
        top = order[np.concatenate([[True], x.owner[order][1:] != x.owner[order][:-1]])]
        target[top[yes[top]]] = 1.0
        if not step:  # only what prior words or other documents speak for
            target[(target > 0) & ~heard] = -1.0
        else:
            p = 1 / (1 + np.exp(-np.clip(margins, -30, 30)))
            target[yes & (p > 0.8)] = 1.0
            # labels that no sentence bears out, and harmless labels on plainly abusive sentences
            best = np.zeros(len(docs))
            np.maximum.at(best, x.owner, p)
            target[(yes & (best < 0.3)[x.owner] & ~heard) | (~yes & (best > 0.8)[x.owner] & (p > 0.5))] = -1.0
        if step == ROUNDS - 1:
            break
        for k in range(FOLDS):
            out = fold == k
            wk, bk = x.train(np.where(out, -1.0, target), x.prior, -3.0, EPOCHS)
            margins[out] = x.margins(wk, bk)[out]
    w, bias = x.train(target, x.prior, -3.0, 2 * EPOCHS)
    keep = np.argsort(-np.abs(w), kind="stable")[:MAX_WEIGHTS]
    names = list(x.vocab)
    return Model({names[i]: float(w[i]) for i in keep if abs(w[i]) > LEAST_WEIGHT}, float(bias))


def zip_words(ws: list[str]) -> list[str]:
    return [a + " " + b for a, b in zip(ws, ws[1:])]


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "abusive") -> list[tuple[str, float]]:
    """At most MAX_LABELLED (text, mean label) pairs, in a fixed order."""
    means = labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y")).where("y is not null and i is not null").groupBy("i").agg(F.avg("y").alias("y")).orderBy(F.xxhash64("i"), "i").limit(MAX_LABELLED)
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text")).where("text is not null")
    # the labelled ids are bounded, so they go to the documents rather than the other way round
    found = texts.join(F.broadcast(means), "i").groupBy("i").agg(F.max("text").alias("text"), F.max("y").alias("y"))
    return [(r.text, r.y) for r in found.orderBy("i").toLocalIterator()]


def scores(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text") -> DataFrame:
    """The columns and the score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b.drop(columns="__text")
            out["score"] = [0.0 if t is None else shared.value.score(t) for t in b["__text"]]
            yield out

    src = docs.select(*columns, F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "__text")
    return spread(src).mapInPandas(run, f"{schema}, score double")
