"""Edit distance within a band, and words as numbers."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

_WORD = re.compile(r"\w+")
_STRIDE = 64


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen again up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


HASHES = WordHashes()


def words_of(text: str | None) -> list[str]:
    """Words in lower case with their digits, without anything between them."""
    return _WORD.findall(text.lower()) if text else []


@lru_cache(3)
def _folds(most: int) -> np.ndarray:
    """For each character below ``most`` its lower case, if that is part of a word, else a space; a new line stays."""
    lower = [c.lower() for c in map(chr, range(most))]
    out = np.fromiter((ord(c) if c[0].isalnum() or c == "_" else 32 for c in (x if len(x) == 1 else " " for x in lower)), np.uint32, most)
    out[10] = 10
    return out


def folded_lines(texts: Sequence[str]) -> tuple[list[str], list[int]]:
    """The lines of all texts, each its words as in :func:`words_of` with a space between them, and how many lines each text has."""
    whole = "\n".join(texts)
    if "\u0130" in whole or "\u03a3" in whole:   # whose lower case is longer, or depends on what is beside it
        whole = whole.lower()
    codes = codes_of(whole)
    most = int(codes.max(initial=0))
    codes = _folds(next(n for n in (1 << 11, 1 << 16, 0x110000) if most < n))[codes]
    blank = codes == 32
    if len(codes):
        codes = codes[np.append(~(blank[1:] & blank[:-1]), True)]
    lines = codes.tobytes().decode("utf-32-le", "surrogatepass").split("\n")
    return [line.strip(" ") for line in lines] if texts else [], [text.count("\n") + 1 for text in texts]


def hashed(words: Sequence[str]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def hashes_of(text: str, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """:func:`hashed` for parts of a text that are all different."""
    data = text.encode("utf-8", "surrogatepass")
    if len(data) > len(text):
        codes = codes_of(text)
        places = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF), out=places[1:])
        begins, ends = places[begins], places[ends]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, [data[i:j] for i, j in zip(begins.tolist(), ends.tolist())]), np.uint64, len(begins))


#: An odd number, and the one that it makes 1 with.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


@lru_cache(4)
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, np.uint64)
    out[0] = 1
    return out.cumprod(dtype=np.uint64)


def numbered_words(lines: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each stretch between single spaces of ``" ".join(lines)`` a number, 0 and up in the order in which they come, at which of them each number comes first, and where they begin and end.

    Words count as equal if the values of their characters as digits of a number, modulo 2 ** 64, are.
    """
    found, passed = [], 0
    for part in _joined(lines):
        codes = codes_of(part)
        spaces = np.flatnonzero(codes == 32)
        starts, ends = np.append(0, spaces + 1), np.append(spaces, len(codes))
        bits = max(20, len(codes).bit_length())
        powers, back = ((_powers if bits == 20 else _powers.__wrapped__)(base, bits) for base in (_BASE, _BACK))
        upto = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * powers[:len(codes)], out=upto[1:])
        found.append(((upto[ends] - upto[starts]) * back[starts], starts + passed, ends + passed))
        passed += len(codes) + 1
    value, starts, ends = (np.concatenate(x) for x in zip(*found))
    ids = pa.array(value).dictionary_encode().indices.to_numpy()
    return ids, np.flatnonzero(np.diff(np.maximum.accumulate(ids), prepend=-1)), starts, ends


def _joined(lines: Sequence[str]) -> Iterator[str]:
    """Parts of ``" ".join(lines)``, without the spaces between them, of under 2 ** 20 characters if lines are shorter."""
    begin, size = 0, 0
    for end, line in enumerate(lines):
        if end > begin and size + len(line) + 1 >= 1 << 20:
            yield " ".join(lines[begin:end])
            begin, size = end, 0
        size += len(line) + 1
    yield " ".join(lines[begin:])


def distance_within(a: Sequence, b: Sequence, most: int) -> int | None:
    """Edit distance of two sequences if it is at most ``most``, else None.

    Aligns along the diagonals of a band of half-width ``most``: for each number of
    edits, how far each diagonal reaches. Similar sequences take few edits, so few steps.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    begin = 0
    short = min(n, m)
    while begin + _STRIDE <= short and a[begin:begin + _STRIDE] == b[begin:begin + _STRIDE]:
        begin += _STRIDE
    while begin < short and a[begin] == b[begin]:
        begin += 1
    if begin == n == m:
        return 0
    while min(n, m) - begin >= _STRIDE and a[n - _STRIDE:n] == b[m - _STRIDE:m]:
        n, m = n - _STRIDE, m - _STRIDE
    while n > begin and m > begin and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    a, b = a[begin:n], b[begin:m]
    n, m = len(a), len(b)
    common = Counter(a)
    common.subtract(Counter(b))
    more = sum(v for v in common.values() if v > 0)
    if max(more, more + m - n) > most:  # at least so many elements have no partner
        return None
    goal, never = m - n, -2
    reach = {0: 0}  # diagonal (position in b less position in a) -> position in a

    def slide(x: int, k: int) -> int:
        y, far = x + k, x + 8
        while x < n and y < m and a[x] == b[y]:
            x += 1
            y += 1
            if x > far:   # a longer match: compare by strides
                while max(x - n, y - m) + _STRIDE <= 0 and a[x:x + _STRIDE] == b[y:y + _STRIDE]:
                    x += _STRIDE
                    y += _STRIDE
                far = x + _STRIDE
        return x

    reach[0] = slide(0, 0)
    if goal == 0 and reach[0] == n:
        return 0
    for edits in range(1, most + 1):
        now = {}
        for k in range(max(-edits, -n), min(edits, m) + 1):
            if abs(goal - k) > most - edits:
                continue
            x = max(reach.get(k, never) + 1, reach.get(k + 1, never) + 1, reach.get(k - 1, never))
            if x < 0:
                continue
            x = min(x, n, m - k)
            now[k] = slide(x, k)
        if now.get(goal, never) >= n:
            return edits
        reach = now
    return None


@lru_cache(256)
def _places(line: str) -> dict[str, int]:
    """For each character a number with a bit for every place it stands at."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    return {chr(c): int.from_bytes(np.packbits(codes == c, bitorder="little").tobytes(), "little") for c in np.unique(codes).tolist()}


def bit_distance(a: str, b: str, most: int) -> int | None:
    """Edit distance of two strings if it is at most ``most``, else None.

    A column of the table of distances is two numbers of ``len(a)`` bits, its rises and falls
    (Myers 1999), so a step costs a few operations on long numbers. It ends as soon as the rest of
    ``b`` is too short to bring the distance down to ``most``.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    if not n:
        return m
    places, every, last = _places(a), (1 << n) - 1, n - 1
    up, down, distance = every, 0, n
    for left, c in zip(range(m - 1, -1, -1), b):
        here = places.get(c, 0)
        across = (((here & up) + up) ^ up) | here
        rise = down | (every & ~(across | up))
        fall = up & across
        distance += (rise >> last & 1) - (fall >> last & 1)
        if distance - left > most:
            return None
        rise, fall, here = (rise << 1 | 1) & every, fall << 1 & every, here | down
        up = fall | (every & ~(here | rise))
        down = rise & here
    return distance if distance <= most else None


#: Pairs whose table of distances is filled side by side; words of 64 rows up to which, and pairs from which on, that pays; the most numbers in a table of places.
_SIDE, _WIDE, _FEW, _PLACES = 4096, 64, 8, 1 << 21
#: The same width, and pairs, for texts of words; the most symbols of texts side by side.
_WIDE_TEXT, _FEW_TEXT, _CELLS = 64, 48, 1 << 22
#: Edits that are looked for along the diagonals first where a pair is done alone.
_NARROW = 24


def codes_of(line: str) -> np.ndarray:
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)


def lines_within(lines: Sequence[str], codes: Sequence[np.ndarray], a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For each pair of lines (numbers ``a``, ``b``) whether at most ``most`` characters are edited.

    The columns of :func:`bit_distance`, for many pairs at once. Long lines, and pairs too few for that, are done one by one.
    What both lines begin and end with costs nothing, so it is left out where it is a good part of them.
    """
    lines, codes, a, b = list(lines), list(codes), a.copy(), b.copy()
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
        begin, end = _ends_alike(codes[i], codes[j])
        if 4 * (begin + end) > min(len(codes[i]), len(codes[j])):
            a[k], b[k] = len(lines), len(lines) + 1
            lines += lines[i][begin:len(lines[i]) - end], lines[j][begin:len(lines[j]) - end]
            codes += codes[i][begin:len(codes[i]) - end], codes[j][begin:len(codes[j]) - end]

    def alone(i: int, j: int, at_most: int) -> bool:
        if len(lines[i]) <= 64 * _WIDE:
            return bit_distance(lines[i], lines[j], at_most) is not None
        few = max(_NARROW, len(lines[i]) // 256)
        return distance_within(lines[i], lines[j], min(at_most, few)) is not None or at_most > few and bit_distance(lines[i], lines[j], at_most) is not None

    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    out = np.maximum(sizes[a], sizes[b]) <= most
    left = np.flatnonzero(~out)
    out[left] = _within(codes, a[left], b[left], most[left], alone, _WIDE, _FEW)
    return out


def _ends_alike(p: np.ndarray, q: np.ndarray) -> tuple[int, int]:
    """How many symbols two sequences begin with alike, and how many of the others they end with alike."""
    n = min(len(p), len(q))
    unlike = p[:n] != q[:n]
    begin = int(unlike.argmax()) if unlike.any() else n
    unlike = p[len(p) - n + begin:][::-1] != q[len(q) - n + begin:][::-1]
    return begin, int(unlike.argmax()) if unlike.any() else n - begin


def texts_within(words: Sequence[np.ndarray], a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The same for texts given as 32-bit numbers of words."""
    def alone(i: int, j: int, at_most: int) -> bool:
        return distance_within(words[i].tolist(), words[j].tolist(), at_most) is not None

    return _within(words, a, b, most, alone, _WIDE_TEXT, _FEW_TEXT)


def _within(codes: Sequence[np.ndarray], a: np.ndarray, b: np.ndarray, most: np.ndarray, alone: Callable[[int, int, int], bool], wide: int, few: int) -> np.ndarray:
    sizes = np.array([len(c) for c in codes], np.int64)
    swap = sizes[a] > sizes[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    words = (sizes[a] + 63) // 64
    out = sizes[b] - sizes[a] <= most
    order = np.lexsort((-sizes[b], words))
    order = order[out[order] & (words[order] > 0)]   # what is empty is as far as the other is long
    begin = 0
    while begin < len(order):
        width = int(words[order[begin]])
        end = int(np.searchsorted(words[order], width + width // 3, side="right"))   # a little wider goes along
        part = order[begin:end]
        part = part[:max(1, min(_SIDE, _CELLS // int(sizes[b[part]].max())))]
        end, width = begin + len(part), int(words[part[-1]])
        if width > wide or len(part) < few:
            for i in part.tolist():
                out[i] = alone(int(a[i]), int(b[i]), int(most[i]))
        else:
            part = part[np.argsort(-sizes[b[part]], kind="stable")]
            out[part] = _columns(codes, a[part], b[part], most[part], width)
        begin = end
    return out


def _columns(codes: Sequence[np.ndarray], a: np.ndarray, b: np.ndarray, most: np.ndarray, width: int) -> np.ndarray:
    """:func:`_within` for sequences ``a`` of up to ``width`` words of 64 symbols; ``b``, at least as long, ordered by falling length.

    Shorter ones stand in the last words. The empty words before them pass on the rise of one that the first word of any gets.
    """
    patterns, row = np.unique(a, return_inverse=True)
    shorter = [codes[i] for i in patterns.tolist()]
    symbols = np.unique(np.concatenate(shorter))
    alike = len(patterns) * (len(symbols) + 1) * width <= _PLACES   # else each pattern has symbols of its own
    tables = [symbols] * len(patterns) if alike else [np.unique(c) for c in shorter]
    starts = np.cumsum([0, *[len(t) + 1 for t in tables]])   # the last of each for symbols the pattern lacks
    if starts[-1] * width > _PLACES and len(patterns) > 1:
        half = len(a) // 2
        return np.concatenate([_columns(codes, a[:half], b[:half], most[:half], width), _columns(codes, a[half:], b[half:], most[half:], width)])
    places = np.zeros((width, int(starts[-1])), np.uint64)
    empty = width - (np.array([len(c) for c in shorter]) + 63) // 64
    for start, own, c, skipped in zip(starts.tolist(), tables, shorter, empty.tolist()):
        at = np.arange(len(c)) + 64 * skipped
        np.bitwise_or.at(places, (at // 64, start + np.searchsorted(own, c)), np.uint64(1) << (at % 64).astype(np.uint64))
    n, m = np.array([len(c) for c in shorter])[row], np.array([len(codes[i]) for i in b.tolist()])
    texts = np.zeros((int(m[0]), len(b)), np.int32)
    known: dict[tuple[int, int], np.ndarray] = {}
    for k, (who, i) in enumerate(zip(row.tolist(), b.tolist())):
        key = (-1 if alike else who, i)
        if key not in known:
            own = tables[who]
            at = np.minimum(np.searchsorted(own, codes[i]), len(own) - 1)
            known[key] = np.where(own[at] == codes[i], at, len(own))
        texts[:m[k], k] = known[key] + starts[who]
    # word k of a column is computed together with word k - 1 of the next one, so that each step does all words of all pairs
    here = np.arange(len(a))
    last, distance = ((n - 1) % 64).astype(np.uint64), n.astype(np.int64)
    one, top = np.uint64(1), np.uint64(63)
    ups = np.where(empty[row] <= np.arange(width)[:, None], ~np.uint64(0), np.uint64(0))
    downs, carries, rises, falls = (np.zeros((width, len(a)), np.uint64) for _ in range(4))
    rises[0] = one
    symbols, places = np.zeros((width, len(a)), np.int64), places.reshape(-1)
    first = np.arange(width)[:, None] * starts[-1]   # of a word's part of ``places``
    out = np.zeros(len(a), bool)
    for step in range(int(m[0]) + width - 1):
        j = step - width + 1   # the column that is completed
        if j > 0 and (j % 16 == 0 or m[here[-1]] <= j):
            ended = m[here] <= j
            out[here[ended]] = distance[ended] <= most[here[ended]]
            go = np.flatnonzero(~ended & (distance - (m[here] - j) <= most[here]))
            if not len(go):
                return out
            if len(go) < len(here):
                here, last, distance = here[go], last[go], distance[go]
                ups, downs, carries, rises, falls, symbols = (x[:, go] for x in (ups, downs, carries, rises, falls, symbols))
        symbols[1:] = symbols[:-1]
        symbols[0] = texts[min(step, len(texts) - 1), here]
        k = min(step + 1, width)
        equal, up, down = places[symbols[:k] + first[:k]], ups[:k], downs[:k]
        total = equal & up
        over = total + up
        more = over < total
        total = over + carries[:k]
        more |= total < over
        total ^= up
        total |= equal
        rise, fall = down | ~(total | up), up & total
        if k == width:
            distance += ((rise[-1] >> last) & one).astype(np.int64) - ((fall[-1] >> last) & one).astype(np.int64)
        equal |= down
        shifted, fallen = (rise << one) | rises[:k], (fall << one) | falls[:k]
        k -= k == width
        carries[1:k + 1], rises[1:k + 1], falls[1:k + 1] = more[:k], rise[:k] >> top, fall[:k] >> top
        np.bitwise_and(shifted, equal, out=down)
        shifted |= equal
        np.bitwise_or(fallen, ~shifted, out=up)
    out[here] = distance <= most[here]
    return out


#: Words left out of two lines, (of the first, of the second), after which they may go on alike.
_GAPS = ((1, 1), (1, 0), (0, 1), (1, 2), (2, 1), (2, 2), (2, 0), (0, 2), (2, 3), (3, 2), (1, 3), (3, 1), (3, 3), (3, 0), (0, 3))

#: Words that are looked at in one step; the longest lines, in words, that go along with others.
_AHEAD, MOST_WORDS = 16, 1024


def words_in_place(lines: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of lines as numbers (one run a line, each followed by 0 five times), the characters before each, where runs begin, and how many words they have."""
    counts = np.fromiter((line.count(" ") + 1 for line in lines), np.int64, len(lines))
    if not len(lines):
        return np.zeros(0, np.int32), np.zeros(0, np.int64), counts, counts
    ids, _, starts, ends = numbered_words([" ", *lines])   # the first two have no characters, as the five behind each line
    begins = np.cumsum(counts + 5) - counts - 5
    place = np.arange(len(ids) - 2) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
    numbers, sizes = np.zeros(int(counts.sum()) + 5 * len(lines), np.int32), np.zeros(int(counts.sum()) + 5 * len(lines), np.int64)
    numbers[place], sizes[place] = ids[2:], (ends - starts)[2:] + 1   # with the space behind
    return numbers, np.cumsum(sizes) - sizes, begins, counts


def surely_within(placed: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray, most: np.ndarray, longest: bool = False) -> np.ndarray:
    """True only for pairs of lines (numbers ``a``, ``b``) that one alignment of their words shows to be at most ``most`` edits apart.

    Many pairs at once go along their lines; where words differ, the first gap after which two words are alike again is taken,
    else one word each. Words left out cost their characters, those that stand for others the longer side's.
    Lines of more than ``MOST_WORDS`` words take as many steps as all others together: ``longest`` tells whether those, and only those, are looked at.
    """
    numbers, before, starts, counts = placed
    out = np.zeros(len(a), bool)
    here = np.flatnonzero((np.maximum(counts[a], counts[b]) > MOST_WORDS) == longest)
    a, b = a[here], b[here]
    i, j = starts[a], starts[b]
    last_i, last_j, left = i + counts[a], j + counts[b], most[here].astype(np.int64)
    stride, edge = np.arange(_AHEAD), len(numbers) - 1
    while len(here):
        like = numbers[np.minimum(i[:, None] + stride, edge)] == numbers[np.minimum(j[:, None] + stride, edge)]
        alike = np.where(like.all(axis=1), _AHEAD, like.argmin(axis=1))
        alike = np.minimum(alike, np.minimum(last_i - i, last_j - j))
        i, j = i + alike, j + alike
        ended = (i >= last_i) | (j >= last_j)
        if ended.any():
            p, q = before[last_i[ended]] - before[i[ended]], before[last_j[ended]] - before[j[ended]]
            out[here[ended]] = np.maximum(p, q) - ((p > 0) & (q > 0)) <= left[ended]
        go = np.flatnonzero(~ended & (left >= 0))
        if len(go) < len(here):
            here, i, j, last_i, last_j, left, alike = here[go], i[go], j[go], last_i[go], last_j[go], left[go], alike[go]
        unlike = np.flatnonzero(alike < _AHEAD)
        if not len(unlike):
            continue
        step_i, step_j = np.zeros(len(here), np.int64), np.zeros(len(here), np.int64)
        step_i[unlike] = step_j[unlike] = 1
        at_i, at_j, open_ = i[unlike], j[unlike], unlike
        for x, y in _GAPS:
            found = (numbers[at_i + x] == numbers[at_j + y]) & (numbers[at_i + x] > 0) & (numbers[at_i + x + 1] == numbers[at_j + y + 1])
            step_i[open_[found]], step_j[open_[found]] = x, y
            at_i, at_j, open_ = at_i[~found], at_j[~found], open_[~found]
            if not len(open_):
                break
        p, q = before[i + step_i] - before[i], before[j + step_j] - before[j]
        left -= np.maximum(p, q) - ((p > 0) & (q > 0))
        i, j = i + step_i, j + step_j
    return out


def similar(a: Sequence, b: Sequence, least: float) -> bool:
    """True if at most ``1 - least`` of the longer sequence is edited."""
    longer = max(len(a), len(b))
    return longer == 0 or distance_within(a, b, int(longer - least * longer + 1e-9)) is not None
