"""Personal data: four fixed patterns, and a semi-Markov conditional random field for what they miss.

:func:`base_spans` applies the fixed patterns. The field scores whole candidate segments: chains of
digit groups and written-out addresses, each with features of the whole span (digits, groups and
their lengths, separators, check digit, octets, words around, what it is cut out of). A segment has
at most ``MOST_GROUPS`` digit groups or ``MOST_LABELS_OF_NAME`` name parts, so dynamic programming
over segment borders is linear in the text and chooses borders and kinds together: sums of all
segmentations for training, the best one for decoding, with weights between the kinds of touching
segments. Text without a candidate is one segmentation and drops out. A segment has to win by
``MARGIN`` over leaving the text alone. What overlaps a span of the fixed patterns is no candidate:
those spans stay as they are.

The field is trained here, on at most ``MOST_EXAMPLES`` generated labelled snippets: real forms of
each kind that the fixed patterns miss, look-alikes (dates, versions, prices, article and order
numbers, digits with a wrong check digit, places written as "at ...") in the same surroundings, and
plain forms beside further numbers. The
surrounding words come from at most ``MOST_CONTEXTS`` documents, by the smallest hashes of their
doc_id, 600 characters each; this is the only part that does not read all data.

Defined cases: a null or empty text has no spans; offsets are code points, end exclusive; of spans
of the fixed patterns several kinds may overlap, spans of the field never do. Repeated rows and null
ids are scanned like any other. Input columns called like the one added are replaced, others stay.
Time is linear in the text: no pattern is searched backwards twice over the same characters.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
MOST_GROUPS, MOST_LABELS_OF_NAME = 8, 6
MARGIN = 1.0
MOST_EXAMPLES, MOST_CONTEXTS = 1600, 300
ROUNDS, RATE, SHRINK = 6, 0.4, 1e-4

Span = tuple[int, int, int]   # start, kind, end

# -- fixed patterns ------------------------------------------------------------------------------
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def digits_of(text: str) -> str:
    return _NOT_DIGITS.sub("", text)


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _octet(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and (not short or int(short) <= 255)


def _emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        free = found.end() if found else at + 1
        if found:
            yield start, EMAIL, free
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    spans = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        spans += [(m.start(), IP, m.end()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        spans += [(m.start(), CARD, m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 12 and 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            spans += [(m.start(), PHONE, m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(spans)


# -- candidate segments and their features -----------------------------------------------------
_GROUP = re.compile(r"[0-9]++")
_BETWEEN = re.compile(r"[\x20\xa0().\[\],:/_‐-―-]{1,3}(?=[0-9])|\x20?[\[(]?(?i:dot)[\])]?\x20?(?=[0-9])")
_AT = re.compile(r"\x20?@\x20?|\x20?[\[({<]\x20?(?i:at|@)\x20?[\])}>]\x20?|\x20(?i:at)\x20")
_DOT = re.compile(r"\.|\x20?[\[({<]\x20?(?i:dot|\.)\x20?[\])}>]\x20?|\x20(?i:dot|\.)\x20")
_LABEL = re.compile(r"[A-Za-z0-9-]{1,63}+(?![A-Za-z0-9-])")
_NAME_BEFORE = re.compile(r"(?:[A-Za-z0-9_%+-]{1,64}(?:\.|\x20dot\x20|\[dot\]|\[\.\]|\(dot\)))?[A-Za-z0-9_%+-]{1,64}\Z")
_AT_SEED = re.compile(r"@|(?<![^\x20\[({<])(?:at|AT|At)(?![^\x20\])}>])")
_WORD = re.compile(r"[^\W\d_]+")
_CUES = {
    "phone": "phone tel telephone call calls called mobile fax cell whatsapp dial ring telefon anruf rufen handy fon téléphone appelez teléfono móvil llama llame",
    "card": "card cards visa mastercard amex credit debit paid karte kreditkarte carte bancaire tarjeta crédito",
    "ip": "ip address host server login from gateway ping adresse dirección serveur servidor",
    "mail": "mail email contact write reach kontakt schreiben courriel écrire contacter correo escribir",
    "other": "order invoice isbn ref reference no number nr id version date total serial item bestellung rechnung facture commande pedido factura page pages chapter",
}
_CUE_OF = {word: cue for cue, words in _CUES.items() for word in words.split()}
_ZONES = frozenset("com org net edu gov info io de fr es uk co eu ch at it nl".split())


@dataclass
class Candidate:
    start: int
    end: int
    kinds: tuple[int, ...]
    features: list[str]


def _left(text: str, start: int) -> list[str]:
    """Words before a segment, and whether something longer goes before it."""
    before = text[max(0, start - 40):start]
    features = [f"left:{cue}" for cue in {_CUE_OF[w] for w in _WORD.findall(before.lower())[-3:] if w in _CUE_OF}]
    if before and (before[-1].isalnum() or before[-1] in "-._/#@+=&%$€£\\"):
        features.append("glued left")
    return features


def _right(text: str, end: int) -> list[str]:
    after = text[end:end + 24]
    features = [f"right:{_CUE_OF[w]}" for w in _WORD.findall(after.lower())[:1] if w in _CUE_OF]
    if after and (after[0].isalnum() or after[0] in "-_/#@+=&%$€£\\" or after[0] in ".," and after[1:2].isalnum()):
        features.append("glued right")
    return features


def _separator(s: str) -> str:
    bare = s.strip(" \xa0")
    return "space" if not bare else "dot word" if "o" in bare.lower() else {"[.]": "dot bracket", "(.)": "dot bracket"}.get(bare, bare[0] + " spaced" * (len(s) > len(bare)))


def _numeric(text: str, groups: list[tuple[int, int]]) -> Iterator[Candidate]:
    """Segments of a chain of digit groups."""
    sizes = [b - a for a, b in groups]
    lefts: dict[int, list[str]] = {}
    rights: dict[int, list[str]] = {}
    for i in range(len(groups)):
        total = 0
        for j in range(i, min(len(groups), i + MOST_GROUPS)):
            total += sizes[j]
            if total > 19:
                break
            n = j - i + 1
            octets = n == 4 and total <= 12 and all(_octet(text[a:b]) for a, b in groups[i:j + 1])
            if total < 7 and not (octets and ("." in text[groups[i][0]:groups[j][1]] or "o" in text[groups[i][0]:groups[j][1]].lower())):
                continue
            if 2 * total < 3 * n and not octets:   # mostly single digits: no kind is written so
                continue
            start, end = groups[i][0], groups[j][1]
            opened = start and text[start - 1] == "("
            start -= bool(opened)
            plus = start and text[start - 1] == "+"
            start -= bool(plus)
            seps = [_separator(text[groups[k][1]:groups[k + 1][0]]) for k in range(i, j)]
            digits = "".join(text[a:b] for a, b in groups[i:j + 1])
            first, last = text[slice(*groups[i])], text[slice(*groups[j])]
            features = ["any number", f"digits {total}", f"groups {n}", "sizes " + "-".join(map(str, sizes[i:j + 1])),
                        *{f"by {s}" for s in seps}, "one separator" if len(set(seps)) == 1 else "no separator" if not seps else "separators",
                        *(lefts.get(start) or lefts.setdefault(start, _left(text, start))), *(rights.get(end) or rights.setdefault(end, _right(text, end)))]
            features += [name for name, holds in (
                ("plus", plus), ("bracket", opened and ")" in text[start:end]), ("half bracket", opened != (")" in text[start:end])), ("octets", octets),
                ("octets by dots", octets and all("dot" in s or s[0] in ".," for s in seps)),
                ("luhn", 12 <= total <= 19 and luhn(digits)), ("no luhn", 12 <= total <= 19 and not luhn(digits)), ("leading zero", first[0] == "0"),
                ("equal groups of 4", n > 2 and set(sizes[i:j]) == {4}), ("pairs", n > 3 and set(sizes[i + 1:j + 1]) == {2}),
                ("pairs after zero", n > 3 and first[0] == "0" and set(sizes[i:j + 1]) == {2}),
                ("year", n == 3 and (len(first) == 4 and first[:2] in ("19", "20") or len(last) == 4 and last[:2] in ("19", "20") and max(sizes[i:j]) <= 2)),
                ("more left", i > 0), ("more right", j + 1 < len(groups)), ("country", first in ("00", "0049", "0033", "0034", "0044", "001", "1")))
                if holds]
            yield Candidate(start, end, (IP, CARD, PHONE), features)


def _chains(text: str) -> Iterator[list[tuple[int, int]]]:
    """Digit groups with nothing but short separators between them."""
    chain: list[tuple[int, int]] = []
    for m in _GROUP.finditer(text):
        if chain and not ((gap := _BETWEEN.match(text, chain[-1][1])) and gap.end() == m.start()):
            yield chain
            chain = []
        chain.append(m.span())
    if chain:
        yield chain


def _named(text: str) -> Iterator[Candidate]:
    """Addresses with the sign or the dots written out."""
    for seed in _AT_SEED.finditer(text):
        at = next((m for k in (2, 1, 0) if seed.start() >= k and (m := _AT.match(text, seed.start() - k)) and m.end() > seed.start()), None)
        if at is None:
            continue
        low = max(0, at.start() - 140)
        name = _NAME_BEFORE.search(text[low:at.start()])
        label = _LABEL.match(text, at.end())
        if name is None or label is None:
            continue
        starts = {low + name.start(), low + name.start() + max((name[0].rfind(s) + len(s) for s in (".", " dot ", "[dot]", "[.]", "(dot)") if s in name[0]), default=0)}
        sign = at[0].strip(" ").lower()
        sign = "sign spaced" if sign == "@" else "sign bare" if sign == "at" else "sign bracket"
        end, dots = label.end(), []
        while len(dots) < MOST_LABELS_OF_NAME and (dot := _DOT.match(text, end)) and (label := _LABEL.match(text, dot.end())):
            end = label.end()
            dots.append("dot plain" if dot[0] == "." else "dot bare" if "o" in dot[0].lower() and dot[0].strip(" ").lower() == "dot" else "dot bracket" if dot[0].strip(" ") != "." else "dot spaced")
            for start in starts:
                features = ["any address", sign, f"labels {len(dots)}", *set(dots), f"{sign} {'/'.join(sorted(set(dots)))}", "known zone" if label[0].lower() in _ZONES else "other zone",
                            *_left(text, start), *_right(text, end)]
                if _DOT.match(text, end) and _LABEL.match(text, _DOT.match(text, end).end()):
                    features.append("more right")
                if start > min(starts):
                    features.append("more left")
                yield Candidate(start, end, (EMAIL,), features)


def candidates(text: str, base: list[Span]) -> list[Candidate]:
    """All segments that the field scores, by start and end."""
    found: list[Candidate] = []
    if _DIGIT.search(text):
        for chain in _chains(text):
            if len(chain) > 1 or 7 <= chain[0][1] - chain[0][0] <= 19:
                found += _numeric(text, chain)
    if "@" in text or "at" in text or "AT" in text or "At" in text:
        found += _named(text)
    if not found:
        return found
    found.sort(key=lambda c: (c.start, c.end))
    if not base:
        return found
    covered: list[list[int]] = []   # base spans joined where they overlap
    for start, _, end in base:
        if covered and start < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])

    def free(c: Candidate) -> bool:
        last = bisect_left(covered, [c.end]) - 1
        return last < 0 or covered[last][1] <= c.start

    return [c for c in found if free(c)]


def islands(found: list[Candidate]) -> Iterator[list[Candidate]]:
    """Candidates that touch or overlap; nothing connects one island to the next."""
    island: list[Candidate] = []
    reach = -1
    for c in found:
        if island and c.start > reach:
            yield island
            island = []
        island.append(c)
        reach = max(reach, c.end)
    if island:
        yield island


# -- the field -----------------------------------------------------------------------------------
def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


@dataclass
class Field:
    """Weights by feature and kind, and between kinds of touching segments (row 0: plain text before)."""

    weights: dict[str, list[float]] = field(default_factory=dict)
    touching: list[list[float]] = field(default_factory=lambda: [[0.0] * 4 for _ in range(5)])

    def score(self, c: Candidate) -> list[float]:
        rows = [w for f in c.features if (w := self.weights.get(f))]
        return [sum(w[kind] for w in rows) for kind in c.kinds]

    def best(self, island: list[Candidate]) -> list[Span]:
        """The best segmentation of an island."""
        at, ends, n = _borders(island)
        ways: list[list[float]] = [[-math.inf] * 5 for _ in range(n)]   # by border and what ends there: text, or a kind
        came: list[list[tuple | None]] = [[None] * 5 for _ in range(n)]
        ways[0][0] = 0.0
        for p in range(n):
            if p:
                state = max(range(5), key=ways[p - 1].__getitem__)
                ways[p][0], came[p][0] = ways[p - 1][state], (p - 1, state, None)
            for c in ends[p]:
                before = at[c.start]
                for kind, score in zip(c.kinds, self.score(c)):
                    state = max(range(5), key=lambda s: ways[before][s] + self.touching[s][kind])
                    value = ways[before][state] + self.touching[state][kind] + score - MARGIN
                    if value > ways[p][kind + 1]:
                        ways[p][kind + 1], came[p][kind + 1] = value, (before, state, c)
        p, state, spans = n - 1, max(range(5), key=ways[n - 1].__getitem__), []
        while step := came[p][state]:
            if step[2]:
                spans.append((step[2].start, state - 1, step[2].end))
            p, state = step[0], step[1]
        return spans[::-1]

    def gradient(self, island: list[Candidate], gold: set[Span]) -> tuple[dict[str, list[float]], list[list[float]]]:
        """Of the log-probability of the gold segmentation: its features less those expected."""
        at, ends, n = _borders(island)
        starts: list[list[tuple[Candidate, list[float]]]] = [[] for _ in range(n)]
        alpha = [[-math.inf] * 5 for _ in range(n)]
        alpha[0][0] = 0.0
        for p in range(n):
            if p:
                alpha[p][0] = _log_sum(alpha[p - 1])
            terms: list[list[float]] = [[] for _ in range(4)]
            for c in ends[p]:
                scores, before = self.score(c), at[c.start]
                starts[before].append((c, scores))
                for kind, score in zip(c.kinds, scores):
                    terms[kind].append(score + _log_sum([a + t[kind] for a, t in zip(alpha[before], self.touching)]))
            for kind in range(4):
                if terms[kind]:
                    alpha[p][kind + 1] = _log_sum(terms[kind])
        whole = _log_sum(alpha[n - 1])
        beta = [[0.0] * 5 for _ in range(n)]
        by_feature: dict[str, list[float]] = {}
        by_touch = [[0.0] * 4 for _ in range(5)]
        for p in range(n - 2, -1, -1):
            for state in range(5):
                beta[p][state] = _log_sum([beta[p + 1][0], *[score + self.touching[state][kind] + beta[at[c.end]][kind + 1]
                                                             for c, scores in starts[p] for kind, score in zip(c.kinds, scores)]])
            for c, scores in starts[p]:
                for kind, score in zip(c.kinds, scores):
                    parts = [math.exp(min(0.0, alpha[p][s] + self.touching[s][kind] + score + beta[at[c.end]][kind + 1] - whole)) for s in range(5)]
                    share = ((c.start, kind, c.end) in gold) - sum(parts)
                    for f in c.features:
                        by_feature.setdefault(f, [0.0] * 4)[kind] += share
                    for s in range(5):
                        by_touch[s][kind] -= parts[s]
                    if (c.start, kind, c.end) in gold:
                        by_touch[next((k + 1 for a, k, b in gold if b == c.start), 0)][kind] += 1
        return by_feature, by_touch


def _borders(island: list[Candidate]) -> tuple[dict[int, int], list[list[Candidate]], int]:
    """Numbers of the borders, and candidates by the border they end at."""
    places = sorted({c.start for c in island} | {c.end for c in island})
    at = {place: i for i, place in enumerate(places)}
    ends: list[list[Candidate]] = [[] for _ in places]
    for c in island:
        ends[at[c.end]].append(c)
    return at, ends, len(places)


def fit(examples: list[tuple[str, set[Span]]]) -> Field:
    """Trained on labelled texts by stochastic gradients with a rate per weight."""
    field_, rates, rng = Field(), {}, random.Random(11)
    given = [(island, {s for s in gold if any((s[0], s[2]) == (c.start, c.end) for c in island)})
             for text, gold in examples for island in islands(candidates(text, base_spans(text)))]
    for _ in range(ROUNDS):
        rng.shuffle(given)
        for island, gold in given:
            by_feature, by_touch = field_.gradient(island, gold)
            rows = [(field_.weights.setdefault(f, [0.0] * 4), rates.setdefault(f, [1e-6] * 4), g) for f, g in by_feature.items()]
            rows += [(field_.touching[s], rates.setdefault(s, [1e-6] * 4), g) for s, g in enumerate(by_touch)]
            for weights, squares, slopes in rows:
                for k in range(4):
                    if slopes[k]:
                        slope = slopes[k] - SHRINK * weights[k]
                        squares[k] += slope * slope
                        weights[k] += RATE * slope / math.sqrt(squares[k])
    return field_


def found_spans(text: str | None, model: Field) -> tuple[list[Span], list[Span]]:
    """Spans of the fixed patterns, and those that the field adds."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, [span for island in islands(candidates(text, base)) for span in model.best(island)]


# -- labelled snippets -----------------------------------------------------------------------------
def _number(rng: random.Random, *sizes: int) -> list[str]:
    return ["".join(rng.choice("0123456789") for _ in range(n)) for n in sizes]


def _card_digits(rng: random.Random, n: int) -> str:
    head = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(n - 2))
    return next(head + d for d in "0123456789" if luhn(head + d))


def _positive(rng: random.Random, words: list[str]) -> tuple[str, int]:
    kind = rng.choice((EMAIL, IP, CARD, PHONE, PHONE))
    word = lambda: rng.choice(words).lower() + rng.choice(("", "", str(rng.randint(1, 99))))
    if kind == EMAIL:
        at = rng.choice((" at ", " AT ", " (at) ", "(at)", "[at]", " [at] ", " @ ", "@ ", "{at}", "@"))
        dot = rng.choice((" dot ", " DOT ", "(dot)", "[.]", " [dot] ", "[dot]", " . ") + (".",) * 3 * (at.strip(" ") != "at" and at.strip(" ") != "AT" and at != "@"))
        local = word() + rng.choice(("", "", "." + word(), "_" + word()))
        return local + at + dot.join([word() for _ in range(rng.choice((1, 1, 2)))] + [rng.choice(("com", "org", "net", "de", "fr", "es", "io"))]), kind
    if kind == IP:
        return rng.choice(("[.]", "(.)", " . ", "[dot]", " dot ", "(dot)")).join(str(rng.randint(0, 255)) for _ in range(4)), kind
    if kind == CARD:
        digits = _card_digits(rng, rng.choice((16, 16, 16, 15)))
        cuts = (4, 10, 15) if len(digits) == 15 else (4, 8, 12, 16)
        return rng.choice((".", "/", "_", " - ", "  ", "\xa0", " / ", ":")).join(digits[a:b] for a, b in zip((0, *cuts), cuts)), kind
    a, b, c = _number(rng, 3, 3, 4)
    a, pairs = str(rng.randint(2, 9)) + a[1:], _number(rng, 2, 2, 2, 2)
    return rng.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"0049 {a} {b}{c}", f"00 44 {pairs[0]} {c} {pairs[1]}{pairs[2]}",
                       f"0{a[:2]} {b}{c}", f"01 {' '.join(pairs)}", f"06.{'.'.join(pairs)}", f"+1/{a}/{b}-{c}", f"({a}){b}-{c}", f"{a} {b} {c}")), kind


def _crowded(rng: random.Random) -> tuple[str, list[Span]]:
    """Plain forms beside further numbers: the fixed patterns take the digits together and drop them."""
    a, b = _number(rng, 3, 4)
    octets = ".".join(str(rng.randint(0, 255)) for _ in range(4))
    text, spans = "", []
    for _ in range(rng.choice((2, 2, 3))):
        card = _card_digits(rng, 16)
        value, kind = rng.choice(((card, CARD), (" ".join(card[i:i + 4] for i in range(0, 16, 4)), CARD), (f"+1 ({a}) 555-{b}", PHONE), (f"+49 {a} {b}{a}", PHONE), (octets, IP),
                                  (card[:-1] + str((int(card[-1]) + 1) % 10), None), (str(rng.randint(1, 99999)), None), (str(rng.randint(1900, 2030)), None)))
        text += " " * bool(text)
        if kind is not None:
            spans.append((len(text), kind, len(text) + len(value)))
        text += value
    return text, spans


def _look_alike(rng: random.Random, words: list[str]) -> str:
    year, month, day = rng.randint(1950, 2035), rng.randint(1, 12), rng.randint(1, 28)
    some = lambda: rng.choice(words).lower()
    wrong = "".join(rng.choice("0123456789") for _ in range(rng.choice((13, 14, 15, 16, 16, 18))))
    wrong = wrong if not luhn(wrong) else wrong[:-1] + str((int(wrong[-1]) + 1) % 10)
    return rng.choice((
        f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{day}/{month}/{year}", f"{year}/{month:02}/{day:02} {day:02}:{month:02}:{day:02}",
        f"{rng.randint(0, 23):02}:{month:02}:{day:02}", ".".join(str(rng.randint(0, 40)) for _ in range(rng.choice((3, 5, 6)))),
        f"{rng.randint(1, 999)},{rng.randint(100, 999)},{rng.randint(100, 999)}.{day:02}", f"{rng.randint(100, 999)}.{rng.randint(100, 999)}.{rng.randint(100, 999)},{day:02}",
        *_number(rng, 7, 8, 9, 10, 11), wrong, " ".join(wrong[i:i + 4] for i in range(0, len(wrong), 4)), ".".join(wrong[i:i + 4] for i in range(0, len(wrong), 4)),
        f"978-3-{day:02}-{rng.randint(100000, 999999)}-{day % 10}", f"{rng.random() * 90:.4f}, {rng.random() * 90:.4f}", " ".join(str(rng.randint(1, 999)) for _ in range(rng.randint(3, 12))),
        rng.choice((" ", " ", ", ", "  ")).join(str(rng.randint(10, 99)) for _ in range(rng.randint(4, 9))),
        f"{year}-{year + 5}", f"{some()} at {some()}.{some()}", f"{some()} at {some()} . {some()}", f"{some()} at the dot", f"{some()} at {some()} {day}.{month}.", f"{some()}-{year}-{rng.randint(10000, 99999)}",
        f"#{rng.randint(10 ** 6, 10 ** 8)}", f"{''.join(rng.choice('0123456789abcdef') for _ in range(rng.choice((8, 16, 32, 40))))}", f"v{day}.{month}.{year}.{rng.randint(1, 9999)}",
        f"{rng.randint(1, 99)}%", f"{some()} @ {some()}", f"{some()}@{some()}", f"{rng.randint(256, 999)}[.]{day}[.]{month}[.]{day}", f"{year} {month:02} {day:02} {rng.randint(1000, 9999)}"))


def labelled(contexts: list[str], n: int = MOST_EXAMPLES, seed: int = 7) -> list[tuple[str, set[Span]]]:
    """``n`` snippets with the spans that the fixed patterns miss."""
    rng, examples = random.Random(seed), []
    words = [w for text in contexts for w in _WORD.findall(text) if w.isascii() and 2 <= len(w) <= 12][:5000] or ["the", "and", "word", "other", "name", "house"]
    cues = [w for w, cue in _CUE_OF.items() if cue != "other"]
    others = _CUES["other"].split()
    while len(examples) < n:
        gold: set[Span] = set()
        pieces = [rng.choice(words) for _ in range(rng.randint(0, 6))]
        for _ in range(rng.choice((1, 1, 2))):
            kind, inside = None, []
            if rng.random() < 0.2:
                value, inside = _crowded(rng)
            elif rng.random() < 0.5:
                value, kind = _positive(rng, words)
                if rng.random() < 0.4:
                    pieces.append(rng.choice([w for w in cues if kind == EMAIL and _CUE_OF[w] == "mail" or _CUE_OF[w] == KINDS[kind]]) + rng.choice(("", ":", " is")))
            else:
                value = _look_alike(rng, words)
                if rng.random() < 0.4:
                    pieces.append(rng.choice(rng.choice((cues, others, others))) + rng.choice(("", ":")))
            if pieces:
                pieces.append(" ")
            start = sum(map(len, pieces)) + sum(1 for a, b in zip(pieces, pieces[1:]) if a != " " and b != " ")
            pieces.append(value)
            if kind is not None:
                gold.add((start, kind, start + len(value)))
            gold |= {(start + a, k, start + b) for a, k, b in inside}
            pieces += [" ", rng.choice(words)] if rng.random() < 0.8 else [rng.choice((".", ",", "\n"))]
            pieces += [rng.choice(words)]
        text = pieces[0]
        for a, b in zip(pieces, pieces[1:]):
            text += ("" if a == " " or b == " " else " ") + b
        base = base_spans(text)
        gold = {g for g in gold if not any(b[0] < g[2] and g[0] < b[2] for b in base)}
        examples.append((text, gold))
    return examples


def train(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", examples: int = MOST_EXAMPLES, contexts: int = MOST_CONTEXTS) -> Field:
    """A field whose examples stand among words of the corpus."""
    share = min(1.0, 2 * contexts / max(1, docs.count()))   # by hash first, so that no task offers more than its share
    some = docs.select(F.pmod(F.xxhash64(F.col(f"`{doc_id}`")), F.lit(1 << 40)).alias("h"), F.substring(F.col(f"`{text}`"), 1, 600).alias("t"))
    some = some.where(F.col("t").isNotNull() & (F.col("h") <= int(share * (1 << 40))))
    return fit(labelled([r.t for r in some.orderBy("h", "t").limit(contexts).collect()], examples))


# -- on documents ----------------------------------------------------------------------------------
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_FOUND = pa.struct([("base", pa.list_(_SPAN)), ("spans", pa.list_(_SPAN))])
_SPAN_TYPE = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())]))
_FOUND_TYPE = StructType([StructField("base", _SPAN_TYPE), StructField("spans", _SPAN_TYPE)])


def _named_spans(spans: list[Span]) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]


def with_personal_data(docs: DataFrame, model: Field, text: str = "text", into: str = "personal") -> DataFrame:
    """``docs`` with a struct of ``base`` spans and all ``spans``, both by start and then kind."""
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts:
            base, added = found_spans(value.as_py(), model)
            rows.append({"base": _named_spans(base), "spans": _named_spans(sorted(base + added))})
        return pa.array(rows, _FOUND)

    finder = F.arrow_udf(find, _FOUND_TYPE).asNondeterministic()  # a filter on the result must not run it a second time
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower()]
    return docs.select(*kept, finder(F.col(f"`{text}`")).alias(into))
