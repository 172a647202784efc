"""Sentences of texts in any script (problem 9).

Every place that can end a sentence (end marks with their closing quotes or brackets, and blanks
between letters of a script written without end marks) is tagged boundary or inside by a linear-chain
model with Viterbi decoding; all other characters are inside by construction, so the chain
runs over these places only. Empty lines always end a sentence, and places within a matched
quotation or bracket never do.

The model is trained on a bounded sample of documents. Labels come from structure: the empty lines of a document are stripped, its paragraphs joined
by a blank, and where they were joined a sentence ends (for unpunctuated scripts the end marks are stripped, too, so that the
letters around a blank must tell). Words that stand before many full stops but never before a stripped empty line don't end
sentences: abbreviations are found by that, in any language, and count as labels in their turn. From these labels a structured perceptron
learns the weights of marks, of the forms of words and of what follows, and those of one boundary following another at
a given distance, which start from the writing conventions stated below.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .unicode_tables import LOOK_ALIKES

SAMPLE_DOCUMENTS = 2000  # documents the weights are adjusted on
SAMPLE_CHARACTERS = 20_000  # longer documents are drawn less often, in proportion
PASSES = 3

# End marks. Those of the second line are not shared with abbreviations or numbers.
STOPS = ".．"
STRONG = "!?！？。｡।॥؟۔።፧፨‼⁇⁈⁉"
ELLIPSES = "…"
CASELESS = "。｡।॥؟۔።፧፨！？"

# Opening marks and their closing ones.
QUOTES = {"“": "”", "«": "»", "「": "」", "『": "』", "„": "“", "‹": "›", "《": "》"}
BRACKETS = {"(": ")", "（": "）", "[": "]", "【": "】", "［": "］"}
OPEN = QUOTES | BRACKETS
CLOSE = {b: a for a, b in OPEN.items() if b != "“"}

# Abbreviations written without a point where blanks end sentences
UNPOINTED = {"ดร", "นพ", "น", "พ.ศ", "ค.ศ"}

_UNSPACED = "ก-๛ກ-ໟက-႟ក-៿"  # scripts that put no end marks
_BREAK = r"(?:\r\n|\r(?!\n)|(?<!\r)[\n\x0b\x0c\x85\u2028])"
_THIN = r"[^\S\n\r\x0b\x0c\x85  ]|[­​-‏⁠﻿]"
_HIDDEN = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"  # fixed values: invisible characters that may stand anywhere
_PARAGRAPH = re.compile(rf"{_BREAK}(?:{_THIN})*{_BREAK}| ")
_MARK = re.compile(
    rf"(?P<end>[{re.escape(STOPS + STRONG + ELLIPSES)}]+(?:[^\S\n\r]*[»›]|[{_HIDDEN}]*[”’\"')\]）」』】］》])*)"
    rf"|(?P<blank>(?<=[{_UNSPACED}])[^\S\n\r]+(?=[{_UNSPACED}]))|(?P<pair>[\"{re.escape(''.join({*OPEN, *CLOSE}))}])"
)
_NEXT_WORD = re.compile(r"\W*(\w+)")
_APART = frozenset("()[]（）“”«»„\"'‘’「」『』,;:،؛、，：；!?")
_GAPS = (4, 8, 16)  # distances between places, in characters, that make a difference to the transition
MARGIN = 2.0  # by which labelled places have to be right
TYPICAL = 5  # places of a word that the other weights are trained on
LIMIT = 8.0  # of the weight of a single word


def _letter(ch: str) -> str:
    """U upper case, l lower case, o letter without case, d digit, p opening mark, x anything else."""
    if ch.isdigit():
        return "d"
    if ch.isalpha():
        return "U" if ch.isupper() or ch.istitle() else "l" if ch.islower() else "o"
    return "p" if ch in OPEN or ch in "\"'‘¿¡-–—" else "x"


def _following(text: str, at: int) -> str:
    """The kind of what follows: e for nothing, n in front if no blank stands between; quotes are looked into."""
    n, i = len(text), at
    while i < n and (text[i].isspace() or text[i] in _HIDDEN):
        i += 1
    if i == n:
        return "e"
    kind = _letter(text[i])
    if kind == "x" and unicodedata.category(text[i]) == "So":  # a pictograph stands before what it goes with
        j = i
        while j < n and (unicodedata.category(text[j]) in ("So", "Mn", "Cf") or text[j].isspace()):
            j += 1
        return ("n" if i == at else "") + (_letter(text[j]) if j < n else "x")
    if kind == "p":
        j = i + 1
        while j < n and not text[j].isalnum() and (text[j] in OPEN or text[j] in _HIDDEN or text[j].isspace() or _letter(text[j]) == "p"):
            j += 1
        kind = "p" + (_letter(text[j]) if j < n else "x")
    return kind if i > at else "n" + kind


@lru_cache(1 << 15)
def _word(word: str) -> tuple[str, str]:
    """A word as it is looked up, and its form: case, length, whether it has vowels and points within."""
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKC", word) if unicodedata.category(c) != "Cf")
        if any("a" <= c <= "z" or "A" <= c <= "Z" for c in word):  # letters of another script among Latin ones
            word = "".join(LOOK_ALIKES.get(c, c) for c in word)
    low = word.lower()
    if not word:
        return low, "none"
    if low.replace(".", "").replace(",", "").isdigit():
        return low, "number"
    if len(word) == 1 and word.isupper():
        return word, "initial"  # a capital of its own is another word than the small letter
    if "." in word[1:] and all(len(x.strip("-")) < 2 for x in word.split(".")):
        return low, "letters" if word[0].islower() else "initials"
    bare = unicodedata.normalize("NFD", low)
    form = _letter(word[0]) + str(min(sum(c.isalpha() for c in bare), 5))
    return low, form + ("" if any(c in "aeiouyɛɔ" for c in bare) or form[0] not in "Ul" else "c")


def _before(text: str, at: int) -> tuple[str, str]:
    """The whole word that a full stop stands after, and its form."""
    i = at
    while i and not (text[i - 1].isspace() or text[i - 1] in _APART):
        i -= 1
    word = text[i:at]
    if word.isdigit() and len(word) <= 3:  # alone in front of its line
        if i and text[i - 1] == "(":
            i -= 1
        while i and text[i - 1].isspace() and text[i - 1] not in "\n\r\u2028":
            i -= 1
        if not i or text[i - 1] in "\n\r\u2028":
            return word, "list"
    return _word(word)


def _last(text: str, at: int) -> str:
    """The last character before ``at`` that is no blank."""
    while at and text[at - 1].isspace():
        at -= 1
    return text[at - 1 : at] if at else ""


def _broken(text: str, at: int) -> bool:
    """Whether a line break follows before the next character."""
    while at < len(text) and text[at].isspace():
        if text[at] in "\n\r\x0b\x0c\x85\u2028":
            return True
        at += 1
    return False


class _Pairs:
    """Matched quotes and brackets: a closing mark closes the nearest of its opening ones, and drops those opened since."""

    def __init__(self):
        self.open: list[tuple[int, str]] = []
        self.where: dict[str, list[int]] = {}
        self.spans: list[tuple[int, int, str]] = []

    def put(self, at: int, c: str) -> None:
        self.where.setdefault(c, []).append(len(self.open))
        self.open.append((at, c))

    def top(self, c: str) -> int | None:
        held = self.where.get(c)
        return held[-1] if held else None

    def close(self, k: int, at: int, kind: str) -> None:
        self.spans.append((self.open[k][0], at, kind))
        while len(self.open) > k:
            self.where[self.open.pop()[1]].pop()


_END_MARKS = re.compile(rf"[{re.escape(STOPS + STRONG + ELLIPSES)}]+")


def places(text: str) -> list[tuple[int, tuple, int]]:
    """``(end, kind, certainty)`` of each place of one paragraph; :func:`features` names what a kind holds. certainty: 1 surely a boundary, -1
    surely inside, 0 open."""
    found, pairs = [], _Pairs()
    for m in _MARK.finditer(text):
        if m.lastgroup == "end":
            found.append(m)
            marks = [(m.start() + i, c) for i, c in enumerate(m.group()) if c in OPEN or c in CLOSE or c == '"']
        elif m.lastgroup == "blank":
            found.append(m)
            continue
        else:
            marks = [(m.start(), m.group())]
        for at, c in marks:
            if c == '"':
                k = pairs.top('"')
                if k is None:
                    pairs.put(at, c)
                elif at == 0 or not text[at - 1].isspace() or at + 1 == len(text) or text[at + 1].isspace():
                    pairs.close(k, at, "q")
            elif c in OPEN and not (c == "“" and pairs.open and pairs.open[-1][1] == "„"):
                pairs.put(at, c)
            elif (k := pairs.top(CLOSE.get(c, "„"))) is not None:
                pairs.close(k, at, "b" if c in BRACKETS.values() else "q")
    outer, closing = [], {b for _, b, _ in pairs.spans}
    for s in sorted(pairs.spans):
        if not outer or s[0] > outer[-1][1]:
            outer.append(s)
    lowered = next((c for c in text if c.isalpha()), "").islower()
    out, k = [], 0
    for m in found:
        a, b = m.span()
        while k < len(outer) and outer[k][1] < a:
            k += 1
        if m.lastgroup == "blank":
            left, right = text[max(0, a - 2) : a], text[b : b + 2]
            hidden = k < len(outer) and outer[k][0] < a
            i = a
            while i and not text[i - 1].isspace():
                i -= 1
            state = "hidden" if hidden else "number" if left[-1:].isdigit() or right[:1].isdigit() else "abbr" if text[i:a] in UNPOINTED else "plain"
            out.append((a, ("T", state, left, right), 0 if state == "plain" else -1))
            continue
        marks = _END_MARKS.match(text, a).group()
        closed, end = "", a + len(marks)
        while True:  # closing marks belong to the sentence only where they close something
            i = end
            while i < b and (text[i].isspace() or text[i] in _HIDDEN):
                i += 1
            if i < b and k < len(outer) and outer[k][1] == i:
                closed, end, k = outer[k][2], i + 1, k + 1
            elif i < b and k < len(outer) and outer[k][0] < i and i in closing:
                end = i + 1
            else:
                break
        if k < len(outer) and outer[k][0] < end <= outer[k][1]:
            out.append((end, ("hidden",), -1))
            continue
        kind = "ell" if marks[0] in ELLIPSES or marks.startswith(("..", "．．")) else "stop" if marks[-1] in STOPS else "strong"
        if marks[-1] in CASELESS and kind != "ell":
            kind = "caseless"
        after = _following(text, end)
        plain = kind == "stop" and not closed and (after[0] != "n" or after == "e")
        word, form = _before(text, a) if plain else ("", "")
        if after == "e":
            out.append((end, ("last", word), 1))
            continue
        last = _last(text, outer[k - 1][0]) if closed == "b" else ""
        shape = kind + (f"/{closed}" if closed else "") + ("!" if last and last in STOPS + STRONG + ELLIPSES else "")
        out.append((end, ("S", shape, after, lowered, word, form, _broken(text, end)), -1 if kind == "stop" and after[0] == "n" else 0))
    return out


def _group(after: str) -> str:
    """What follows, as far as a single word's weight depends on it: a new word, a small letter or a number."""
    return "low" if after in ("l", "pl") else "digit" if after in ("d", "pd") else "new"


def features(kind: tuple) -> list[str]:
    """The names of the weights that a place's score is the sum of."""
    if kind[0] == "S":
        _, shape, after, lowered, word, form, broken = kind
        group = _group(after)
        out = [f"{shape}|{after}"] + ([f"{shape}|{after}|lowered"] if lowered else []) + ([f"break|{group}"] if broken else [])
        if form:
            out += [f"form {form}|{group}", f"word {word}|{group}"]
        return out
    if kind[0] == "T":
        return [f"blank {kind[1]}"] + ([] if kind[1] != "plain" else [f"blank <{kind[2]}", f"blank >{kind[3]}"])
    return [kind[0]]


def conventions(feature: str) -> float:
    """The weight a feature starts from: above 0 for a boundary."""
    if feature == "last":
        return 9.0
    if feature in ("hidden", "blank hidden", "blank number", "blank abbr"):
        return -9.0
    if feature == "blank plain":
        return 3.0
    name, _, rest = feature.partition("|")
    if name in ("form list", "form initial", "form initials"):
        return -9.0
    if name == "break":
        return 3.0 if rest == "digit" else 0.0  # an item of a list
    if name == "form letters":
        return -2.0 if rest == "low" else 0.0
    if not rest or name[:5] in ("form ", "word ", "blank"):
        return 0.0
    after, _, detail = rest.partition("|")
    kind, _, closed = name.partition("/")
    glued, following = after[0] == "n" and after != "n", after.lstrip("n") or "x"
    low = following in ("l", "pl")
    if detail:
        return 2.0 if kind == "stop" and low and not closed and not glued else 0.0
    if closed.startswith("b"):
        return 3.0 if closed.endswith("!") and not low else -3.0
    if kind == "caseless":
        return -3.0 if following == "x" and closed else 3.0 if not (closed and low) else -3.0
    if kind == "strong":
        return -3.0 if closed and low or glued and following not in ("U", "pU", "o") or following == "x" else 3.0
    if glued:
        return -3.0 if kind == "ell" or not closed else 3.0 if following in ("o", "U") else -3.0
    if kind == "ell":
        return 3.0 if following in ("U", "pU", "d", "pd") else -1.5
    return (-3.0 if closed else -1.0) if low else -3.0 if following == "x" else 3.0


class Chain:
    """The linear chain: weights of features, and of one boundary right after another at each of the distances."""

    def __init__(self, weights: dict[str, float] | None = None, again: tuple[float, ...] = (0.0,) * (len(_GAPS) + 1)):
        self.weights, self.again, self._scores = dict(weights or {}), list(again), {}

    def weight(self, feature: str) -> float:
        w = self.weights.get(feature)
        return conventions(feature) if w is None else w

    def score(self, kind: tuple) -> float:
        got = self._scores.get(kind)
        if got is None:
            if len(self._scores) > 200_000:
                self._scores.clear()
            got = self._scores[kind] = sum(map(self.weight, features(kind)))
        return got

    def tags(self, scores: list[float], gaps: list[int]) -> list[bool]:
        """The best path. A tag's score is half its place's, with the tag's sign; gaps are the distances from the place before."""
        inside, boundary, back = 0.0, 0.0, []
        for s, g in zip(scores, gaps, strict=True):
            h, stay = s / 2, boundary + (self.again[g] if back else 0.0)
            back.append((boundary > inside, stay > inside))
            inside, boundary = max(inside, boundary) - h, max(inside, stay) + h
        tag, out = boundary > inside, []
        for to_inside, to_boundary in reversed(back):
            out.append(tag)
            tag = to_boundary if tag else to_inside
        return out[::-1]

    def tagged(self, got: list[tuple[int, tuple, int]]) -> list[bool]:
        return self.tags([self.score(kind) for _, kind, _ in got], distances([e for e, _, _ in got]))


def distances(ends: list[int]) -> list[int]:
    """The class of each place's distance from the one before."""
    return [bisect_left(_GAPS, e - before) for before, e in zip([-100, *ends[:-1]], ends, strict=True)] if ends else []


def joined(text: str) -> list[tuple[int, tuple, int, str]]:
    """The places of a text whose empty lines are stripped, and the word after each; where empty lines stood a sentence surely ends."""
    parts = [x for p in _PARAGRAPH.split(text) if (x := p.strip())]
    if re.search(rf"[{_UNSPACED}]\s*{_BREAK}\s*{_BREAK}\s*[{_UNSPACED}]", text):
        parts = [x for p in parts if (x := p.rstrip(STOPS + STRONG + ELLIPSES).rstrip())]  # only the letters around the blank tell
    joins, at = set(), 0
    for p in parts[:-1]:
        joins.add(at + len(p))
        at += len(p) + 1
    whole = " ".join(parts)
    return [(e, kind, 1 if e in joins and not c else c, m.group(1) if (m := _NEXT_WORD.match(whole, e)) else "") for e, kind, c in places(whole)]


def _means_it(kind: tuple) -> bool:
    """Whether the writing convention of a mark other than the full stop is to end a sentence here."""
    return conventions(features(kind)[0]) > 0


def word_weights(chains: list[list[tuple[int, tuple, int, str]]], running: Counter) -> dict[str, float]:
    """Weights of single words before a full stop, by what follows: the logarithm of how much likelier what was seen of them is if they end
    sentences than if they don't, at most LIMIT.

    Of the sentences' ends a certain share stands before a stripped empty line: a word that ends sentences is found there as often as that,
    one that doesn't all but never. A word that is mostly followed by words that begin sentences elsewhere, too, is likelier to end
    sentences, though others follow in languages of many forms. And words never seen without a full stop are a little likelier abbreviations."""
    final, open_, starters, after = Counter(), Counter(), Counter(), defaultdict(list)
    for chain in chains:
        for _, kind, c, word in chain:
            if kind[0] == "last" and kind[1]:
                final[kind[1]] += 1
            elif kind[0] == "S":
                if c > 0 or c == 0 and not kind[5] and _means_it(kind):
                    starters[word] += 1
                if kind[5] and kind[5] not in ("list", "number", "none"):
                    if c > 0:
                        final[kind[4]] += 1
                    else:
                        open_[kind[4], _group(kind[2])] += 1
                        after[kind[4]].append(word)
    new = sum(n for (_, group), n in open_.items() if group == "new")
    odds = sum(final.values()) / max(new, 1)  # of a sentence's end standing before an empty line
    known = sum(n - 1 for n in starters.values()) / max(sum(starters.values()), 1)  # share of first words that begin another sentence, too
    known = min(max(known, 0.5), 0.95)
    out = {}
    for (word, group), n in open_.items():
        against = n * odds - 4.0 * final[word] + (min(0.4 * (n - 1), 2.0) if not running[word] else -2.0 if running[word] > n else 0.0)
        if group == "new":
            begun = sum(starters[x] > 0 for x in after[word])
            against += min(max((len(after[word]) - begun) * math.log(0.9 / (1 - known)) - begun * math.log(known / 0.1), -4.0), 0.0)
        # a word that ends sentences may still stand within one before a small letter
        out[f"word {word}|{group}"] = -min(max(against, 0.0 if group == "low" else -LIMIT / 2), LIMIT)
    return out


def train(texts: list[str], passes: int = PASSES) -> Chain:
    """A model of the texts: weights of words from their counts, all others and the transition by a structured perceptron."""
    chains, running = [], Counter()
    for text in texts:
        if got := joined(text):
            chains.append(got)
        for token in text.split():
            if token[-1] != ".":
                running[_word(token.strip("".join(_APART)))[0]] += 1
    words = word_weights(chains, running)
    examples, met = [], Counter()
    for chain in chains:
        names, labels = [], []
        for _, kind, c, _ in chain:
            word = f"word {kind[4]}|{_group(kind[2])}" if kind[0] == "S" and kind[5] else ""
            known, named = words.get(word, 0.0), features(kind)
            if not c and (known <= -4.0 or known >= 2.0 and not word.endswith("low")):
                c, met[word] = (1 if known > 0 else -1), met[word] + 1
                if met[word] <= TYPICAL:  # forms, marks and distances are to tell such words without knowing them
                    named = [f for f in named if f[:5] != "word "]
            elif not c and kind[0] == "S" and not word:
                c = 1 if _means_it(kind) else -1
            names.append(named)
            labels.append(c)
        examples.append((names, labels, distances([e for e, *_ in chain])))
    model = adjusted(examples, passes, words)
    return Chain({f: w for f, w in model.weights.items() if abs(w - conventions(f)) > 1e-6}, tuple(model.again))


def adjusted(examples: list[tuple[list[list[str]], list[int], list[int]]], passes: int, held: dict[str, float] | None = None) -> Chain:
    """Averaged weights, with those in ``held`` as they are, those of the transition among them, after passes over chains of ``(features, labels, distances)``; a label is 1, -1
    or, where unknown, 0. A labelled place has to be right by a margin."""
    held = held or {}
    model, total, seen = Chain(held), defaultdict(float), 0
    turns = [0.0] * len(model.again)
    for _ in range(passes):
        for places_, labels, gaps in examples:
            seen += 1
            scores = [sum(map(model.weight, f)) for f in places_]
            got = model.tags([s - MARGIN * c for s, c in zip(scores, labels, strict=True)], gaps)
            want = model.tags([99.0 * c or s for s, c in zip(scores, labels, strict=True)], gaps)
            if got == want:
                continue
            for g, w, f in zip(got, want, places_, strict=True):
                if g != w:
                    step = 0.1 if w else -0.1
                    for x in f:
                        if x in held:
                            continue
                        model.weights[x] = model.weight(x) + step
                        total[x] += step * seen
            for side, sign in ((want, 0.1), (got, -0.1)):
                for (a, b), g in zip(pairwise(side), gaps[1:], strict=True):
                    if a and b:
                        model.again[g] += sign
                        turns[g] += sign * seen
    return Chain({x: w - total[x] / (seen + 1) for x, w in model.weights.items()}, tuple(w - t / (seen + 1) for w, t in zip(model.again, turns, strict=True)))


def sentences(text: str | None, model: Chain) -> list[tuple[int, int]]:
    """``(start, end)`` of each sentence in code points, in order; none for null, empty and blank texts."""
    out: list[tuple[int, int]] = []
    if not text:
        return out
    breaks = [(m.start(), m.end()) for m in _PARAGRAPH.finditer(text)] + [(len(text), len(text))]
    begin = 0
    for stop, resume in breaks:
        paragraph = text[begin:stop]
        got = places(paragraph)
        ends = [e for (e, _, _), tag in zip(got, model.tagged(got), strict=True) if tag]
        at = 0
        for e in [*ends, len(paragraph)]:
            piece = paragraph[at:e]
            core = piece.strip()
            if core:
                start = begin + at + len(piece) - len(piece.lstrip())
                out.append((start, start + len(core)))
            at = max(at, e)
        begin = resume
    return out


def fitted(documents: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE_DOCUMENTS, characters: int = SAMPLE_CHARACTERS) -> Chain:
    """The model adjusted on about ``sample`` whole documents drawn by a hash of the key: the only data that reaches the driver.

    A document of more than ``characters`` is drawn less often, by characters / length, and never cut, so that
    about sample x characters are expected at most for any corpus."""
    rows = documents.filter(F.col(text).isNotNull())
    share = min(1.0, sample / max(rows.count(), 1))
    most = int(share * 1_000_000) * F.least(F.lit(1.0), characters / F.greatest(F.length(text), F.lit(1)))
    rows = rows.filter(F.pmod(F.xxhash64(F.lit(5), key), F.lit(1_000_000)) < most).select(key, F.col(text).alias("t"))
    return train([r["t"] for r in sorted(rows.collect())])


def sentence_spans(documents: DataFrame, text: str = "text", key: str = "doc_id", model: Chain | None = None) -> DataFrame:
    """``(key, start_at, end_at)``: one row per sentence of every document, whole texts whatever their length."""
    model = model or fitted(documents, text, key)
    weights = documents.sparkSession.sparkContext.broadcast((model.weights, model.again))  # features are of fixed kinds, but for letter pairs of unspaced scripts

    def run(batches):
        chain = Chain(*weights.value)
        for batch in batches:
            ids, starts, ends = [], [], []
            for i, t in enumerate(batch.column(text).to_pylist()):
                for a, b in sentences(t, chain):
                    ids.append(i)
                    starts.append(a)
                    ends.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(ids, pa.int64())), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], [key, "start_at", "end_at"])

    kind = dict(documents.dtypes)[key]
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, start_at long, end_at long")


def violations(documents: DataFrame, spans: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(documents, overlapping, blank_edges, uncovered)``: documents, sentences that begin before the one before ends, sentences with blanks around them, and
    documents with characters other than blanks outside all sentences. All but the first ought to be 0."""
    blank = r"[\s\p{Z}\x{85}\x{1C}-\x{1F}]"
    order = F.array_sort(F.collect_list(F.struct("start_at", "end_at")))
    both = documents.select(key, F.coalesce(text, F.lit("")).alias("__t")).join(spans.groupBy(key).agg(order.alias("__s")), key, "left").withColumn("__s", F.coalesce("__s", F.array().cast("array<struct<start_at: long, end_at: long>>")))
    cut = F.transform("__s", lambda x: F.substr("__t", x["start_at"].cast("int") + 1, (x["end_at"] - x["start_at"]).cast("int")))
    bare = lambda t: F.length(F.regexp_replace(t, f"(?U){blank}", ""))
    early = F.size(F.filter("__s", lambda x, i: (i > 0) & (x["start_at"] < F.get("__s", i - 1)["end_at"])))
    edges = F.size(F.filter(cut, lambda t: t.rlike(f"(?U)^{blank}|{blank}$")))
    return both.select(early.alias("a"), edges.alias("b"), (bare(F.concat_ws("", cut)) != bare(F.col("__t"))).alias("c")).agg(
        F.count("*").alias("documents"), F.coalesce(F.sum("a"), F.lit(0)).cast("long").alias("overlapping"), F.coalesce(F.sum("b"), F.lit(0)).cast("long").alias("blank_edges"), F.count_if("c").alias("uncovered"))


def sentence_rows(documents: DataFrame, text: str = "text", key: str = "doc_id", model: Chain | None = None) -> DataFrame:
    """``(key, n, start_at, end_at, sentence)``: the sentences themselves, numbered from 1."""
    from pyspark.sql import Window

    spans = sentence_spans(documents, text, key, model)
    numbered = spans.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("start_at")))
    return numbered.join(documents.select(key, text), key).select(key, "n", "start_at", "end_at", F.substr(text, F.col("start_at").cast("int") + 1, (F.col("end_at") - F.col("start_at")).cast("int")).alias("sentence"))
