"""Language of texts by a linear-chain conditional random field over words."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import BROADCAST_ROWS, free_name, give_back, let_go, slices, uniform, worker_state
from rowloom.session import materialise

# Bytes of labelled text that one task fits at a time, the sequences that it trains on at least, by repeating its own, and the shares that add up their weights.
SHARE_BYTES = 8_000_000
SEQUENCES = 48_000
GROUP_SHARES = 2
SEQUENCE_WORDS = 24
# Sequences of a training step: in a share that repeats its own, and in others.
STEP, LARGE_STEP = 256, 1_024
# Weights are added up over shares as whole numbers of this part, so that the sum does not depend on their order.
WEIGHT_UNIT = 2.0**-24
# Distinct counts that a task holds before it passes them on.
HELD_COUNTS = 250_000
# Documents that make a word known as one.
KNOWN_DOCS = 3
SLOTS = 1 << 17
# Words whose scores a worker remembers, about 250 bytes each; others are scored anew.
REMEMBERED = 150_000
# UTF-8 bytes of text that are labelled at a time, but for a longer text; words whose features are held at a time; and words by languages of a step.
SLICE_BYTES = 3_000_000
FEATURE_WORDS = 20_000
STEP_CELLS = 1_000_000
UNKNOWN = "und"
# Most letters of a word; what is longer is no word of a language, and is cut into several.
WORD_LETTERS = 24
_WORD = re.compile(r"[^\W\d_]+")
_WORD_LETTER = re.compile(r"[^\W\d_]")


def words_of(text: str) -> list[str]:
    """Runs of letters; longer ones, as of scripts without blanks, in pieces of like length that follow each other."""
    runs = _WORD.findall(text.lower())
    if max(map(len, runs), default=0) <= WORD_LETTERS:
        return runs
    words = []
    for run in runs:
        n = -(-len(run) // WORD_LETTERS)
        words += [run[len(run) * k // n : len(run) * (k + 1) // n] for k in range(n)]
    return words


_letters: list[np.ndarray] = []
# An odd factor by place in a text, for the hashes that tell the words of a few texts apart.
_FACTOR = np.uint64(random.Random(0).getrandbits(64) >> 3 << 3 | 5)
# Letters that are hashed at a time, and the factor's powers for them.
BLOCK = 1 << 16
_POWERS = np.cumprod(np.append(np.ones(1, np.uint64), np.full(BLOCK, _FACTOR)))


def _letter_tables() -> list[np.ndarray]:
    """Whether each code point is a letter of a word, and a number of 64 mixed bits for each."""
    if not _letters:
        table = np.zeros(0x110000, bool)
        for at in range(0, len(table), BLOCK):
            # Surrogates are no characters.
            points = (x for x in range(at, at + BLOCK) if not 0xD800 <= x < 0xE000)
            table[[ord(c) for c in _WORD_LETTER.findall("".join(map(chr, points)))]] = True
        mixed = np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        _letters.extend((table, mixed ^ (mixed >> np.uint64(31))))
    return _letters


def _blocks(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """The text's code points, so many at a time that they take little memory, each time with their place."""
    for at in range(0, len(text), BLOCK):
        yield at, _code_points(text[at : at + BLOCK]).astype(np.int64)


def _runs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of letters begin and end (exclusive)."""
    is_letter, edges, before = _letter_tables()[0], [], False
    for at, points in _blocks(text):
        inside = np.concatenate(([before], is_letter[points]))
        edges.append(np.flatnonzero(inside[1:] != inside[:-1]) + at)
        before = inside[-1]
    if before:
        edges.append(np.array([len(text)]))
    found = np.concatenate(edges) if edges else np.zeros(0, np.int64)
    return found[::2], found[1::2]


def _sums_between(text: str, begins: np.ndarray, ends: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """The sums of the letters' numbers, times powers of the factor, from each begin to each end, both in order; ``highs`` has a block's power."""
    mixed, before = _letter_tables()[1], np.zeros(1, np.uint64)
    sums = [(places, np.zeros(len(places), np.uint64)) for places in (begins, ends)]
    for (at, points), high in zip(_blocks(text), highs, strict=False):
        running = np.concatenate((before, mixed[points]))
        running[1:] *= _POWERS[: len(points)]
        running[1:] *= high
        np.cumsum(running, out=running)
        for places, found in sums:
            a, b = np.searchsorted(places, (at, at + len(points)), side="right")
            found[a:b] = running[places[a:b] - at]
        before = running[-1:]
    return sums[1][1] - sums[0][1]


def split_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of the texts in order of arrival, the number of each word among them, and how many words each text has.

    The words are those of ``words_of``, found in all texts at once.
    """
    lowered = [t.lower() for t in texts]
    joined = "\n".join(lowered)
    begins, ends = _runs(joined)
    if not len(begins):
        return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    lengths = ends - begins
    if lengths.max() > WORD_LETTERS:
        n = -(-lengths // WORD_LETTERS)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        run, runs, n = np.repeat(begins, n), np.repeat(lengths, n), np.repeat(n, n)
        begins, lengths = run + runs * k // n, runs * (k + 1) // n - runs * k // n
        ends = begins + lengths
    highs = np.cumprod(np.append(np.ones(1, np.uint64), np.full(len(joined) // BLOCK, _POWERS[BLOCK])))
    # A word's hash is its part of the sums, times what makes it the same at every place.
    hashes, behind = _sums_between(joined, begins, ends, highs), len(joined) - begins
    hashes *= _POWERS[behind % BLOCK]
    hashes *= highs[behind // BLOCK]
    # Numbers in order of arrival; of the places of a number the first is written last.
    ids = pa.array(hashes).dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.empty(int(ids.max()) + 1, np.int64)
    first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
    spans = zip(begins[first].tolist(), ends[first].tolist(), strict=True)
    stops = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
    return [joined[a:b] for a, b in spans], ids, np.diff(np.searchsorted(begins, stops), prepend=0)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _marked(words: list[str]) -> str:
    """The words, each between its marks."""
    return "^" + "$^".join(words) + "$" if words else ""


def _crc_next(crc: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The registers of CRC-32 after one more letter each, in UTF-8."""

    def byte(crc: np.ndarray, value: np.ndarray) -> np.ndarray:
        return _CRC[(crc ^ value) & 0xFF] ^ (crc >> 8)

    wide = np.flatnonzero(letters >= 0x80)
    if not len(wide):
        return byte(crc, letters)
    points = letters[wide]
    # Bytes behind the first one of a letter.
    more = (points >= 0x800).astype(np.uint32) + (points >= 0x10000) + 1
    lead = letters.copy()
    lead[wide] = np.array([0, 0xC0, 0xE0, 0xF0], np.uint32)[more] | (points >> (6 * more))
    found = byte(crc, lead)
    for k in (1, 2, 3):
        there = np.flatnonzero(more >= k)
        if len(there):
            at = wide[there]
            found[at] = byte(found[at], 0x80 | (points[there] >> (6 * (more[there] - k)) & 0x3F))
    return found


def feature_counts(words: list[str]) -> np.ndarray:
    """How many features each word has (see ``feature_slots``)."""
    return 2 * np.fromiter(map(len, words), np.int64, len(words)) + 9


def feature_slots(words: list[str], lexicon: WordTable) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the words' features, one word after the other, and how many each has.

    A word has itself, its affixes of up to three letters, its two- and three-grams, and its lexicon. A slot is the CRC-32 of kind and
    feature; all words are hashed at once.
    """
    raw = list(map(str.encode, words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = _code_points(_marked(words))
    begins = np.cumsum(lengths + 2) - lengths - 2
    ends = begins + lengths + 1

    def start(kind: bytes, n: int) -> np.ndarray:
        return np.full(n, zlib.crc32(kind) ^ 0xFFFFFFFF, np.uint32)

    def slots(crc: np.ndarray) -> np.ndarray:
        return ((crc ^ np.uint32(0xFFFFFFFF)) % SLOTS).astype(np.int32)

    sizes = feature_counts(words)
    starts = np.cumsum(sizes) - sizes
    flat = np.empty(int(sizes.sum()), np.int32)
    whole = zlib.crc32(b"w ")
    flat[starts] = np.fromiter(map(zlib.crc32, raw, repeat(whole)), np.int64, len(raw)) % SLOTS
    head = tail = None
    for n in (1, 2, 3):
        # A word shorter than that is its own affix.
        long = lengths >= n
        more = _crc_next(start(b"p ", len(words)) if head is None else head, letters[np.minimum(begins + n, ends)])
        head = more if head is None else np.where(long, more, head)
        more = start(b"s ", len(words))
        for back in range(n, 0, -1):
            more = _crc_next(more, letters[np.maximum(ends - back, 0)])
        tail = more if tail is None else np.where(long, more, tail)
        flat[starts + n], flat[starts + 3 + n] = slots(head), slots(tail)
    one = _crc_next(start(b"g ", len(letters)), letters)
    two = _crc_next(one[:-1], letters[1:])
    three = _crc_next(two[:-1], letters[2:])
    inside = np.ones(len(letters), bool)
    inside[ends] = False
    at = np.flatnonzero(inside)
    flat[at + np.repeat(starts + 7 - begins, lengths + 1)] = slots(two[at])
    inside[ends - 1] = False
    at = np.flatnonzero(inside)
    flat[at + np.repeat(starts + 8 + lengths - begins, lengths)] = slots(three[at])
    label = lexicon.find(WordTable.hashes_of(raw), -1)
    labels = range(-1, int(label.max(initial=-1)) + 1)
    flat[starts + sizes - 1] = np.array([zlib.crc32(f"l {x}".encode()) % SLOTS for x in labels], np.int32)[label + 1]
    return flat, sizes


def word_features(word: str, lexicon: WordTable) -> list[int]:
    """Slots of a word's features (see ``feature_slots``)."""
    return feature_slots([word], lexicon)[0].tolist()


class WordRows:
    """A row of numbers for each of many distinct words, by ``make``; remembered in an array that doubles as it grows, while there is room."""

    def __init__(self, make: Callable[[list[str]], np.ndarray]):
        self.make, self.known, self.table = make, {}, None

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        ids = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(ids < 0)
        if not len(new):
            return self.table[ids] if len(ids) else self.make([])
        fresh = [words[i] for i in new.tolist()]
        made = self.make(fresh)
        rows = np.empty((len(words), made.shape[1]), made.dtype)
        rows[new] = made
        if len(new) < len(words):
            old = ids >= 0
            rows[old] = self.table[ids[old]]
        used, need = len(known), len(known) + len(fresh)
        if need <= REMEMBERED:
            known.update(zip(fresh, range(used, need), strict=True))
            if self.table is None or need > len(self.table):
                grown = np.empty((min(REMEMBERED, max(need, 2 * used)), made.shape[1]), made.dtype)
                if used:
                    grown[:used] = self.table[:used]
                self.table = grown
            self.table[used:need] = made
        return rows


@dataclass
class Field:
    """Weights of word features and of transitions between the languages of neighbouring words."""

    languages: list[str]
    lexicon: WordTable
    weights: np.ndarray
    moves: np.ndarray
    usual: Familiarity | None = None

    def __post_init__(self):
        self.rows = WordRows(self.word_rows)

    def word_rows(self, words: list[str]) -> np.ndarray:
        """What is remembered of each word: its scores, and its likelihood by letter and its letters if that is asked. No numbers if it holds no letter."""
        letters = have_letters(words)
        rows = self.word_scores(words)
        if self.usual:
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            rows = np.concatenate((rows, np.stack((self.usual.likelihoods(words) / sizes, sizes), axis=1).astype(np.float32)), axis=1)
        rows[~letters] = np.nan
        return rows

    def word_scores(self, words: list[str]) -> np.ndarray:
        """One row of scores per word."""
        out = np.empty((len(words), len(self.languages)), np.float32)
        for at in range(0, len(words), FEATURE_WORDS):
            slots, counts = feature_slots(words[at : at + FEATURE_WORDS], self.lexicon)
            sums = np.add.reduceat(np.take(self.weights, slots, axis=0), np.cumsum(counts) - counts, axis=0)
            out[at : at + FEATURE_WORDS] = sums / np.sqrt(counts)[:, None]
        return out


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward sums, scaled per word, and the words' own factors.

    ``scores`` is (words, sequences, labels), sequences in descending order of ``lengths``. What lies
    beyond a sequence's end is 0 in the sums.
    """
    longest, sequences, labels = scores.shape
    running = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")
    local = _factors(scores)
    forward, backward = np.zeros_like(local), np.zeros_like(local)
    by_label = [np.ascontiguousarray(np.moveaxis(x, 2, 0)).reshape(labels, -1) for x in (local, forward, backward)]
    _sums(*by_label, np.arange(longest) * sequences, running, moves)
    forward, backward = (np.ascontiguousarray(np.moveaxis(x.reshape(labels, longest, sequences), 0, 2)) for x in by_label[1:])
    return forward, backward, local


def _factors(scores: np.ndarray) -> np.ndarray:
    """The words' own factors; the largest of each word is 1."""
    top = scores[..., 0].copy()
    for k in range(1, scores.shape[-1]):
        np.maximum(top, scores[..., k], out=top)
    local = scores - top[..., None]
    return np.exp(local, out=local)


def _sums(local: np.ndarray, forward: np.ndarray, backward: np.ndarray, starts: np.ndarray, running: np.ndarray, moves: np.ndarray) -> None:
    """Fill in forward and backward sums, scaled per word, of sequences in descending order of length.

    All have a row per label and a column per word: the first words of all sequences, then the second words of all that have one, and
    so on; ``starts`` and ``running`` have the first column and the number of sequences of each.
    """
    labels = len(local)
    step = np.exp(moves)
    back, ones = np.ascontiguousarray(step.T), np.ones(labels, local.dtype)
    columns, counts = starts.tolist(), running.tolist()
    before = None
    for at, n in zip(columns, counts, strict=True):
        ahead = local[:, at : at + n]
        if before is not None:
            ahead = np.matmul(back, forward[:, before : before + n]) * ahead
        np.divide(ahead, np.matmul(ones, ahead), out=forward[:, at : at + n])
        before = at
    after, m = 0, 0
    for at, n in zip(reversed(columns), reversed(counts), strict=True):
        if n > m:
            backward[:, at + m : at + n] = 1.0 / labels
        if m:
            behind = np.matmul(step, local[:, after : after + m] * backward[:, after : after + m])
            np.divide(behind, np.matmul(ones, behind), out=backward[:, at : at + m])
        after, m = at, n


def marginals(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """Posterior of every label at every word; 0 beyond a sequence's end."""
    both = forward * backward
    total = (both @ np.ones(both.shape[-1], both.dtype))[..., None]
    return np.divide(both, total, out=np.zeros_like(both), where=total > 0)


class WordTable:
    """A number for each of many words, known by 64-bit hashes (those of Spark's ``xxhash64``); a fraction of a dictionary in size."""

    def __init__(self, hashes: np.ndarray, numbers: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], numbers[order]

    @classmethod
    def of(cls, numbers: dict[str, int]) -> WordTable:
        return cls(np.array([cls.hash(w) for w in numbers], np.int64), np.array(list(numbers.values()), np.int64))

    @staticmethod
    def hash(word: str) -> int:
        found = xxhash.xxh64_intdigest(word.encode(), 42)
        return found - (1 << 64) if found >> 63 else found

    @staticmethod
    def hashes_of(raw: list[bytes]) -> np.ndarray:
        """The hashes of words in UTF-8."""
        return np.fromiter(map(xxhash.xxh64_intdigest, raw, repeat(42)), np.uint64, len(raw)).view(np.int64)

    def find(self, hashes: np.ndarray, default: int = 0) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), default, np.int64)
        at = np.minimum(self.hashes.searchsorted(hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], default)

    def get(self, word: str, default: int = 0) -> int:
        return int(self.find(np.array([self.hash(word)], np.int64), default)[0])


def fit(samples: list[tuple[str, str]], seed: int = 11) -> Field | None:
    """Fit the field on texts with languages, all in one share (see ``learn``); None without any words."""
    seen: dict[str, Counter] = defaultdict(Counter)
    amounts: Counter = Counter()
    for text, lang in samples:
        words = [w for w in words_of(text) if w.isalpha()]
        amounts[lang] += len(words)
        for word in set(words):
            seen[word][lang] += 1
    languages = sorted({lang for _, lang in samples})
    lexicon = {}
    for word, counts in seen.items():
        (top, n), total = counts.most_common(1)[0], sum(counts.values())
        if total >= KNOWN_DOCS and n >= 0.9 * total:
            lexicon[word] = languages.index(top)
    if not seen:
        return None
    _, weights, moves, _ = fit_share(samples, languages, WordTable.of(lexicon), [amounts[x] for x in languages], seed)
    return Field(languages, WordTable.of(lexicon), weights, moves)


class _Numbers(dict):
    """A number for each word that ``keep`` approves of, in order of arrival, and -1 for others."""

    def __init__(self, keep: Callable[[list[str]], np.ndarray]):
        super().__init__()
        self.keep, self.n = keep, 0

    def of(self, words: list[str]) -> np.ndarray:
        """The numbers of distinct words."""
        found = np.fromiter(map(self.get, words, repeat(-2)), np.int64, len(words))
        new = np.flatnonzero(found == -2)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            kept = self.keep(fresh)
            found[new] = np.where(kept, self.n + np.cumsum(kept) - 1, -1)
            self.n += np.count_nonzero(kept)
            self.update(zip(fresh, found[new].tolist(), strict=True))
        return found

    def kept(self) -> list[str]:
        """The words in order of their numbers."""
        return [w for w, i in self.items() if i >= 0]


def _sequences(samples: list[tuple[str, str]], number: dict[str, int], rng: random.Random) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts in sequences of up to ``SEQUENCE_WORDS``: the distinct words, and per sequence word numbers, labels and lengths.

    A document's words carry its language. Up to half of the sequences are spliced: two of different languages change their
    ends, so transitions are learned from text that switches, and each word is in one sequence.
    """
    known = _Numbers(lambda words: np.fromiter(map(str.isalpha, words), bool, len(words)))
    rows, labels, lengths = [], [], []
    for at, stop in slices([len(text) for text, _ in samples], SLICE_BYTES):
        distinct, found, counts = split_words([text for text, _ in samples[at:stop]])
        found = known.of(distinct)[found]
        text = np.repeat(np.arange(stop - at), counts)[found >= 0]
        found = found[found >= 0]
        counts = np.bincount(text, minlength=stop - at)
        # A text's words fill as many sequences as it takes.
        sequences = -(-counts // SEQUENCE_WORDS)
        place = np.arange(len(found)) - (np.cumsum(counts) - counts)[text]
        table = np.full((int(sequences.sum()), SEQUENCE_WORDS), -1, np.int32)
        table[(np.cumsum(sequences) - sequences)[text] + place // SEQUENCE_WORDS, place % SEQUENCE_WORDS] = found
        rows.append(table)
        labels.append(np.repeat(np.array([number[lang] for _, lang in samples[at:stop]], np.int16), sequences))
        lengths.append((table >= 0).sum(axis=1))
    words = np.concatenate(rows) if rows else np.zeros((0, SEQUENCE_WORDS), np.int32)
    labels = np.concatenate(labels) if rows else np.zeros(0, np.int16)
    lengths = np.concatenate(lengths) if rows else np.zeros(0, np.int64)
    truth = np.repeat(labels[:, None], SEQUENCE_WORDS, axis=1)
    labels = labels.tolist()
    order = list(range(len(words)))
    rng.shuffle(order)
    sizes, spliced = lengths.tolist(), []
    for one, other in zip(order[::2], order[1::2], strict=False):
        cut = rng.randint(4, SEQUENCE_WORDS - 4)
        if labels[one] == labels[other] or min(sizes[one], sizes[other]) <= cut or 4 * len(spliced) >= len(words):
            continue
        spliced.append((one, other, cut))
    if spliced:
        # A sequence is in one pair at most, so all change their ends at once.
        ones, others, cuts = np.array(spliced).T
        behind = np.arange(SEQUENCE_WORDS) >= cuts[:, None]
        for table in (words, truth):
            table[ones], table[others] = np.where(behind, table[others], table[ones]), np.where(behind, table[ones], table[others])
        lengths[ones], lengths[others] = lengths[others], lengths[ones]
    return known.kept(), words, truth, lengths


def _distinct(numbers: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order, and the place of each among them; ``places`` is an array for all that may occur, of any content."""
    met = np.zeros(len(places), bool)
    met[numbers] = True
    found = np.flatnonzero(met)
    places[found] = np.arange(len(found))
    return found, places[numbers]


def fit_share(samples: list[tuple[str, str]], languages: list[str], lexicon: WordTable, amounts: list[int], seed: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Fit weights and moves on all words of the texts: the number of sequences, weights, moves, and the slots that were met.

    ``amounts`` are the words of each language in the whole corpus; a language's sequences weigh by its inverse, so that all
    languages have equal odds. A share of fewer than ``SEQUENCES`` sequences goes over its own again.
    """
    rng = random.Random(seed)
    distinct, words, labels, lengths_of = _sequences(samples, {lang: i for i, lang in enumerate(languages)}, rng)
    weights, moves = np.zeros((SLOTS, len(languages)), np.float32), np.zeros((len(languages), len(languages)), np.float32)
    if not len(words):
        return 0, weights, moves, np.zeros(0, np.int64)
    model = Field(languages, lexicon, weights, moves)
    sizes = feature_counts(distinct)
    begins = np.cumsum(sizes) - sizes
    all_slots, met = np.empty(int(sizes.sum()), np.int32), np.zeros(SLOTS, bool)
    for at in range(0, len(distinct), FEATURE_WORDS):
        some = feature_slots(distinct[at : at + FEATURE_WORDS], lexicon)[0]
        all_slots[begins[at] : begins[at] + len(some)] = some
        met[some] = True
    word_places, slot_places = np.empty(len(distinct), np.int32), np.empty(SLOTS, np.int32)
    odds = sum(amounts) / (np.maximum(amounts, 1) * max(1, np.count_nonzero(amounts)))
    share = (odds[labels] * (words >= 0)).sum(axis=1) / lengths_of
    past_w, past_m = np.full(weights.shape, 1e-6, np.float32), np.full(moves.shape, 1e-6, np.float32)
    # As many rounds as reach the least number of sequences; the rate falls from round to round, by quarters of the whole.
    rounds = -(-SEQUENCES // len(words)) if len(words) < SEQUENCES else 1
    size = STEP if rounds > 1 else LARGE_STEP
    turns = np.random.default_rng(seed)
    for turn in range(rounds):
        rate = 0.5 / (1 + 4 * turn // rounds)
        order = turns.permutation(len(words))
        for at in range(0, len(order), size):
            batch = order[at : at + size]
            batch = batch[np.argsort(-lengths_of[batch], kind="stable")]
            lengths = lengths_of[batch]
            place, label = words[batch, : lengths[0]].T, labels[batch, : lengths[0]].T
            inside = place >= 0
            used, local_id = _distinct(place[inside], word_places)
            counts = sizes[used]
            starts = np.cumsum(counts) - counts
            owner = np.repeat(np.arange(len(used)), counts)
            flat = all_slots[np.arange(len(owner)) + (begins[used] - starts)[owner]]
            touched, spot = _distinct(flat, slot_places)
            root = np.sqrt(counts)[:, None].astype(np.float32)
            word_scores = np.add.reduceat(np.take(model.weights, flat, axis=0), starts, axis=0) / root
            scores = np.zeros((*place.shape, len(languages)), np.float32)
            truth = np.zeros_like(scores)
            scores[inside] = word_scores[local_id]
            truth[(*np.nonzero(inside), label[inside])] = 1
            forward, backward, local = forward_backward(scores, lengths, model.moves)
            wrong = ((marginals(forward, backward) - truth) * share[batch][None, :, None])[inside]
            step = np.empty((len(touched), len(languages)), np.float32)
            for column in range(len(languages)):
                by_word = np.bincount(local_id, wrong[:, column], len(used)) / root[:, 0]
                step[:, column] = np.bincount(spot, by_word[owner], len(touched))
            held = model.weights[touched]
            step = step / len(batch) + 1e-6 * held
            past = past_w[touched] + step**2
            past_w[touched] = past
            model.weights[touched] = held - rate * step / np.sqrt(past)
            # Expected minus seen transitions.
            both = inside[1:] & inside[:-1]
            if not both.any():
                continue
            heavy = np.broadcast_to(share[batch][None], both.shape)[both]
            pair = forward[:-1][both][:, :, None] * np.exp(model.moves)[None] * (local[1:] * backward[1:])[both][:, None, :]
            pair = pair / pair.sum(axis=(1, 2), keepdims=True)
            seen = np.bincount(label[:-1][both].astype(np.int64) * len(languages) + label[1:][both], heavy, len(languages) ** 2).reshape(moves.shape)
            move = ((pair * heavy[:, None, None]).sum(axis=0) - seen) / len(batch) + 1e-4 * model.moves
            past_m += move**2
            model.moves -= 0.2 * rate * move / np.sqrt(past_m)
    return len(words), model.weights, model.moves, np.flatnonzero(met)


def _mass(scores: list[np.ndarray], moves: np.ndarray) -> np.ndarray:
    """The posteriors of each sequence, summed over its words; sequences in descending order of length, each with a word."""
    sizes = np.array([len(s) for s in scores])
    running = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    starts = np.cumsum(running) - running
    # The words by their place in a sequence, and by sequence.
    flat = np.empty((int(sizes.sum()), len(moves)), np.float32)
    for b, rows in enumerate(scores):
        flat[starts[: len(rows)] + b] = rows
    local = np.ascontiguousarray(_factors(flat).T)
    forward, backward = np.empty_like(local), np.empty_like(local)
    _sums(local, forward, backward, starts, running, moves)
    forward *= backward
    total = np.matmul(np.ones(len(moves), np.float32), forward)
    posterior = np.divide(forward, total, out=np.zeros_like(forward), where=total > 0)
    mass = np.zeros((len(moves), len(scores)), np.float32)
    for at, n in zip(starts.tolist(), running.tolist(), strict=True):
        mass[:, :n] += posterior[:, at : at + n]
    return mass.T


def label_texts(model: Field, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
    """Language, score and strangeness of each text.

    The language is the one with the largest posterior mass over the text's words, the score its share. The
    strangeness is that of ``Familiarity``, infinite without words, 0 if the model has none.
    """
    distinct, ids, lengths = split_words([t or "" for t in texts])
    scores = np.take(model.rows.of(distinct), ids, axis=0) if distinct else model.word_rows([])
    labels = len(model.languages)
    good = np.flatnonzero(~np.isnan(scores[:, 0]))
    text = np.repeat(np.arange(len(texts)), lengths)[good]
    sizes = np.bincount(text, minlength=len(texts))
    begins = np.cumsum(sizes) - sizes
    mass = np.zeros((len(texts), labels))
    order = np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes)]
    # Sequences of like length together, of a bounded number of words.
    for at, stop in slices((sizes[order] * labels).tolist(), STEP_CELLS):
        group = order[at:stop]
        mass[group] = _mass([scores[good[a : a + n], :labels] for a, n in zip(begins[group].tolist(), sizes[group].tolist(), strict=True)], model.moves)
    best = mass.argmax(axis=1)
    total = mass.sum(axis=1)
    languages = [model.languages[b] if t > 0 else UNKNOWN for b, t in zip(best.tolist(), total.tolist(), strict=True)]
    shares = np.divide(mass.max(axis=1), total, out=np.zeros(len(texts)), where=total > 0)
    strange = [0.0] * len(texts)
    if model.usual:
        for i, (a, n) in enumerate(zip(begins.tolist(), sizes.tolist(), strict=True)):
            span = good[a : a + n]
            _, first, counts = np.unique(ids[span], return_index=True, return_counts=True)
            rows = scores[span[first], labels:].astype(np.float64)
            strange[i] = model.usual.apartness(rows[:, 0], rows[:, 1] * counts) if len(span) else math.inf
    return languages, np.clip(shares, 0.0, 1.0).tolist(), strange


def word_spans(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The words of a text as ``words_of`` gives them, and where each begins and ends in it, in code points."""
    lowered = text.lower()
    # Some characters are several in lower case.
    origin = None if len(lowered) == len(text) else np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
    words, spans = [], []
    for found in _WORD.finditer(lowered):
        run, at = found[0], found.start()
        n = -(-len(run) // WORD_LETTERS)
        for k in range(n):
            start, end = len(run) * k // n, len(run) * (k + 1) // n
            words.append(run[start:end])
            spans.append((at + start, at + end) if origin is None else (int(origin[at + start]), int(origin[at + end - 1]) + 1))
    return words, spans


def label_runs(model: Field, text: str | None) -> list[dict]:
    """Runs of neighbouring words that most likely have the same language, in order.

    Each has ``start`` and ``end`` (code points, exclusive), ``language``, ``posterior`` (the mean of its words') and ``words``.
    """
    words, spans = word_spans(text or "")
    if not words:
        return []
    distinct = list(dict.fromkeys(words))
    place = dict(zip(distinct, range(len(distinct)), strict=True))
    scores = model.rows.of(distinct)[[place[w] for w in words], : len(model.languages)]
    good = np.flatnonzero(~np.isnan(scores[:, 0]))
    if not len(good):
        return []
    posterior = marginals(*forward_backward(scores[good][:, None], np.array([len(good)]), model.moves)[:2])[:, 0]
    labels = posterior.argmax(axis=1)
    edges = np.flatnonzero(np.diff(labels, prepend=-1))
    runs = []
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(labels)], strict=True):
        mean = float(posterior[a:b, labels[a]].mean())
        runs.append({"start": spans[good[a]][0], "end": spans[good[b - 1]][1], "language": model.languages[labels[a]], "posterior": min(mean, 1.0), "words": b - a})
    return runs


class Familiarity:
    """How likely words are in any learned language: counts of words and of their runs of up to three letters.

    Words of fewer than ``KNOWN_DOCS`` documents go by their letters alone, though they count among all. A word's likelihood is half that of the word itself and half that of its letters, each given the
    two before it. A text's is the mean of its words', per letter, so text that switches languages is as likely as others.
    """

    def __init__(self, words: WordTable, total: int, grams: dict[str, int]):
        """``words`` holds those that are known as words; ``total`` and ``grams`` count all."""
        self.words, self.total, self.grams = words, total, grams
        self.letters = sum(n for g, n in self.grams.items() if len(g) == 1 and g != "^")
        self.center = self.apart = self.within = self.limit = 0.0
        self._forget()

    def _forget(self) -> None:
        """Nothing is remembered: the logarithms of ``_chance`` by runs, packed as numbers in order, and the words' likelihoods by letter."""
        self.runs, self.logs = np.zeros(0, np.int64), np.zeros(0)
        self.rows = WordRows(lambda words: self.likelihoods(words)[:, None] / (np.fromiter(map(len, words), np.int64, len(words)) + 1)[:, None])

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("runs", "logs", "rows")}

    def __setstate__(self, state: dict):
        self.__dict__.update(state)
        self._forget()

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """The logarithm of each word's likelihood; of ``FEATURE_WORDS`` words at a time."""
        made = [self._likelihoods(words[at : at + FEATURE_WORDS]) for at in range(0, len(words), FEATURE_WORDS)]
        return np.concatenate(made) if made else np.zeros(0)

    def _likelihoods(self, words: list[str]) -> np.ndarray:
        letters = _code_points(_marked(words)).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(lengths + 2) - lengths - 2
        # The run that ends at each letter but the first: the two letters before it, or the first alone, and it.
        runs = letters.copy()
        runs[1:] |= letters[:-1] << 21
        runs[2:] |= letters[:-2] << 42
        runs[begins + 1] &= (1 << 42) - 1
        inside = np.ones(len(runs), bool)
        inside[begins] = False
        spelled = np.add.reduceat(self._log_chances(runs[inside]), begins - np.arange(len(words)))
        counts = self.words.find(WordTable.hashes_of([w.encode() for w in words]))
        held = np.flatnonzero(counts)
        spelled[held] = np.logaddexp(np.log(counts[held] / self.total), spelled[held])
        return spelled - math.log(2)

    def _log_chances(self, packed: np.ndarray) -> np.ndarray:
        """The logarithm of ``_chance`` of runs, of 21 bits a letter; remembered while there is room."""

        def find() -> tuple[np.ndarray, np.ndarray]:
            at = np.minimum(self.runs.searchsorted(packed), max(0, len(self.runs) - 1))
            return at, self.runs[at] != packed if len(self.runs) else np.ones(len(packed), bool)

        at, missing = find()
        if missing.any():
            new = np.unique(packed[missing])
            if len(self.runs) + len(new) > REMEMBERED:
                new, self.runs, self.logs = np.unique(packed), self.runs[:0], self.logs[:0]
            spelled = ["".join(map(chr, filter(None, (run >> 42, run >> 21 & 0x1FFFFF, run & 0x1FFFFF)))) for run in new.tolist()]
            runs = np.concatenate((self.runs, new))
            logs = np.concatenate((self.logs, [math.log(self._chance(run)) for run in spelled]))
            order = np.argsort(runs)
            self.runs, self.logs = runs[order], logs[order]
            at = find()[0]
        return self.logs[at]

    def _chance(self, run: str) -> float:
        """How likely the last letter of a run is after the one or two before it."""
        grams = self.grams
        chance = (grams.get(run[-1], 0) + 0.01) / (self.letters + 1000)
        for lo in range(len(run) - 2, -1, -1):
            chance = (grams.get(run[lo:], 0) + 2 * chance) / (grams.get(run[lo:-1], 0) + 2)
        return chance

    def texts(self, texts: list[str]) -> list[tuple[float, float, float]]:
        """Per text with letters the mean by letter, the number of words that it rests on (a repeated one counts as one), and the words' variance."""
        distinct, ids, lengths = split_words(texts)
        if not distinct:
            return []
        found = self.rows.of(distinct)[:, 0]
        letters = np.where(have_letters(distinct), np.fromiter(map(len, distinct), np.int64, len(distinct)) + 1, 0)
        made = []
        for words in np.split(ids, np.cumsum(lengths)[:-1]):
            used, counts = np.unique(words[letters[words] > 0], return_counts=True)
            if not len(used):
                continue
            values, sizes = found[used], (letters[used] * counts).astype(np.float64)
            mean = float((values * sizes).sum() / sizes.sum())
            made.append((mean, float(sizes.sum() ** 2 / (sizes**2).sum()), float((sizes * (values - mean) ** 2).sum() / sizes.sum())))
        return made

    def apartness(self, values: np.ndarray, sizes: np.ndarray) -> float:
        """By how many deviations of texts of this length a text lies below the learned ones, by its distinct words' likelihoods and letters."""
        total = sizes.sum()
        mean, n = (values * sizes).sum() / total, total**2 / (sizes**2).sum()
        return float((self.center - mean) / math.sqrt(self.apart + self.within / n))


def has_letter(word: str) -> bool:
    """Whether a word holds a letter; what only looks like one, as superscripts do, does not."""
    return word.isalpha() or any(c.isalpha() for c in word)


def have_letters(words: list[str]) -> np.ndarray:
    """Whether each word holds a letter (see ``has_letter``)."""
    found = np.fromiter(map(str.isalpha, words), bool, len(words))
    for i in np.flatnonzero(~found).tolist():
        found[i] = has_letter(words[i])
    return found


class WordCounts:
    """How often, and in how many texts, each word with a letter occurs."""

    def __init__(self):
        self.numbers = _Numbers(have_letters)
        self.n = self.docs = np.zeros(0, np.int64)

    def add(self, texts: list[str]) -> None:
        distinct, ids, lengths = split_words(texts)
        if not distinct:
            return
        ids = self.numbers.of(distinct)[ids]
        there, size = ids >= 0, max(1, self.numbers.n)
        ids, text = ids[there], np.repeat(np.arange(len(texts)), lengths)[there]
        # Each word of a text once; sorting takes a fraction of the time that unique, which hashes, does.
        pairs = np.sort(text * size + ids)
        n, docs = (np.bincount(x, minlength=size) for x in (ids, pairs[np.diff(pairs, prepend=-1) != 0] % size))
        n[: len(self.n)] += self.n
        docs[: len(self.docs)] += self.docs
        self.n, self.docs = n, docs


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; a null id counts as an empty one."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 11) -> Field | None:
    """Fit on the whole texts of all labelled documents that are not held out; see ``learn``."""
    rows = labelled(docs, doc_id, text, lang, seed)
    return learn(rows, counted(rows, halves=False), seed)


def labelled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 11) -> DataFrame:
    """``lang, text, u, v, half`` of the labelled documents that are not held out, whole; ``u`` is a hash in [0, 1), ``half`` 0 or 1 by another.

    Documents of equal id, text and language count once. Which of them repeat is found by hashes alone; texts are neither moved nor written for
    it unless very many do, so ``docs`` is read anew by each step that uses the rows.
    """
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(doc_id)))
    usable = usable.select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), uniform(F.lit(seed), F.col(doc_id), F.col(text)).alias("u"),
        F.xxhash64(F.lit(seed + 1), F.col(doc_id), F.col(text)).alias("v"),
    )
    key = ["lang", "u", "v"]
    repeated = materialise(usable.groupBy(*key).count().where("count > 1").select(*key), "repeated")
    n = repeated.count()
    if n > BROADCAST_ROWS:
        rows = materialise(usable.dropDuplicates(key), "labelled")
    elif n:
        single = usable.join(F.broadcast(repeated), key, "left_anti")
        rows = single.unionByName(usable.join(F.broadcast(repeated), key, "left_semi").dropDuplicates(key))
    else:
        rows = usable
    return rows.select("lang", "text", "u", "v", F.pmod("v", F.lit(2)).cast("int").alias("half"))


def counted(rows: DataFrame, halves: bool = True) -> DataFrame:
    """``name, lang, half, n, docs``: how often, and in how many of ``rows``, each word with a letter occurs; without ``halves``, not by ``half``."""
    kinds = ["lang", "half"] if halves else ["lang"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: dict[tuple, WordCounts] = defaultdict(WordCounts)
        for batch in batches:
            for at, stop in slices(pc.binary_length(batch.column("text")).to_pylist(), SLICE_BYTES):
                part = batch.slice(at, stop - at)
                texts: dict[tuple, list[str]] = defaultdict(list)
                for text, *kind in zip(*(part.column(c).to_pylist() for c in ("text", *kinds)), strict=True):
                    texts[tuple(kind)].append(text)
                for kind, some in texts.items():
                    held[kind].add(some)
                if sum(len(c.numbers) for c in held.values()) >= HELD_COUNTS:
                    yield from passed(held)
                    held.clear()
        yield from passed(held)
        held.clear()
        give_back()

    def passed(held: dict) -> Iterator[pa.RecordBatch]:
        for kind, counts in held.items():
            names = pa.array(counts.numbers.kept(), pa.string())
            named = [pa.array([value] * len(names), types[c]) for c, value in zip(kinds, kind, strict=True)]
            size = len(names)
            yield pa.RecordBatch.from_arrays([names, *named, pa.array(counts.n[:size]), pa.array(counts.docs[:size])], names=["name", *kinds, "n", "docs"])

    from pyspark.sql.pandas.types import to_arrow_type

    types = {c: to_arrow_type(rows.schema[c].dataType) for c in kinds}
    schema = ", ".join(["name string", *[f"{c} {rows.schema[c].dataType.simpleString()}" for c in kinds], "n bigint", "docs bigint"])
    found = rows.select("text", *kinds).mapInArrow(count, schema)
    return materialise(found.groupBy("name", *kinds).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "word-counts")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each share (the first column) of a batch as one compressed value: what is shuffled is less than half of the text."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=1))
    for batch in batches:
        batch = batch.take(pc.sort_indices(batch.column(0)))
        numbers = batch.column(0).to_numpy()
        edges = np.flatnonzero(np.diff(numbers, append=-1)) + 1
        made = []
        for a, b in zip([0, *edges.tolist()], edges.tolist(), strict=False):
            sink = pa.BufferOutputStream()
            rows = pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[1:]], names=batch.schema.names[1:])
            with pa.ipc.new_stream(sink, rows.schema, options=options) as stream:
                stream.write_batch(rows)
            made.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(numbers[edges - 1], pa.int32()), pa.array(made, pa.binary())], names=["share", "rows"])


def _unpacked(values: pa.ChunkedArray) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(v.as_buffer()).read_all() for v in values])


def learn(rows: DataFrame, counts: DataFrame, seed: int = 11) -> Field | None:
    """The field of all ``rows`` (see ``labelled``, ``counted``); None without any words.

    The lexicon lists words of at least three documents, nine in ten of them of one language. Rows are dealt by hash into shares of about
    ``SHARE_BYTES``. Each share is fitted on all its words (``fit_share``), and a slot's weights are the mean over the shares that met it, by their
    sequences. So all text is shuffled once, compressed, to tasks of bounded size, and what reaches the driver is the model.
    """
    sizes = {r["lang"]: r["size"] for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("size")).collect()}  # one row per language
    languages = sorted(sizes)
    words = counts.where(~F.col("name").rlike(r"[^\p{L}]"))
    total = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not total:
        return None
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    by_lang = words.groupBy("name", "lang").agg(F.sum("docs").alias("docs"))
    told = by_lang.groupBy("name").agg(F.sum("docs").alias("all"), F.max(F.struct("docs", number[F.col("lang")].alias("label"))).alias("top"))
    told = told.where((F.col("all") >= KNOWN_DOCS) & (F.col("top.docs") >= 0.9 * F.col("all")))
    listed = told.select(F.xxhash64("name").alias("hash"), F.col("top.label").cast("long").alias("label")).toArrow()
    lexicon = WordTable(listed["hash"].to_numpy(), listed["label"].to_numpy())
    shares = max(1, round(sum(sizes.values()) / SHARE_BYTES))
    sent = rows.sparkSession.sparkContext.broadcast((languages, lexicon, [total.get(x, 0) for x in languages], seed))

    def share(key: tuple, table: pa.Table) -> pa.Table:
        let_go()
        languages, lexicon, amounts, seed = sent.value
        # By slot the sequences that met it and their weights; behind the slots, a row for the moves from each language.
        total = np.zeros((SLOTS + len(languages), 1 + len(languages)), np.int64)
        numbers = table["share"].to_numpy()
        for number in np.unique(numbers).tolist():
            rows = _unpacked(table["rows"].filter(pa.array(numbers == number)))
            rows = rows.sort_by([("u", "ascending"), ("v", "ascending"), ("lang", "ascending")])
            samples = list(zip(rows["text"].to_pylist(), rows["lang"].to_pylist(), strict=True))
            n, weights, moves, met = fit_share(samples, languages, lexicon, amounts, seed + number)
            met = np.concatenate((met, SLOTS + np.arange(len(moves))))
            values = np.concatenate((weights, moves))[met].astype(np.float64)
            total[met, 0] += n
            total[met, 1:] += np.rint(values * n / WEIGHT_UNIT).astype(np.int64)
        give_back()
        met = np.flatnonzero(total[:, 0])
        return pa.table({"slot": met} | {c: total[met, i] for i, c in enumerate(("n", *names))})

    names = [f"w{i}" for i in range(len(languages))]
    dealt = rows.select(F.floor(F.col("u") * shares).cast("int").alias("share"), "text", "lang", "u", "v").mapInArrow(_packed, "share int, rows binary")
    # Several shares to a group, whose sums are passed on once, where the cores have enough with that; sums of whole numbers do not depend on it.
    groups = max(shares // GROUP_SHARES, min(shares, 2 * rows.sparkSession.sparkContext.defaultParallelism))
    grouped = dealt.groupBy(F.floor(F.col("share") * groups / F.lit(shares)).alias("group"))
    fitted = grouped.applyInArrow(share, ", ".join(["slot bigint", "n bigint", *[f"{n} bigint" for n in names]]))
    sums = fitted.groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).toArrow()  # a row per slot
    weights = np.zeros((SLOTS + len(languages), len(languages)), np.float32)
    values = np.stack([sums[c].to_numpy() for c in names], axis=1) * WEIGHT_UNIT / np.maximum(sums["n"].to_numpy(), 1)[:, None]
    weights[sums["slot"].to_numpy()] = values
    return Field(languages, lexicon, weights[:SLOTS].copy(), weights[SLOTS:].copy())


def _letter_runs(marked: Column) -> Column:
    """All runs of one, two and three letters."""

    def of(size: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(marked) - size + 1), lambda at: F.substr(marked, at, F.lit(size)))

    return F.concat(*[of(size) for size in (1, 2, 3)])


def familiar(rows: DataFrame, counts: DataFrame) -> Familiarity | None:
    """Counts of all ``rows`` (see ``labelled``, ``counted``), and what is usual among them; None without any words.

    What is usual is fitted on texts that were not counted: each half of the rows is judged by the other. The limit is half as
    much again as what one text in 200 exceeds, and at least ten deviations. The places in these orders are exact on
    values rounded to five digits, so that they are found from a bounded number of counts.
    """
    spark = rows.sparkSession
    by_half = [F.sum(F.when(F.col("half") == half, F.col(c)).otherwise(0)).alias(f"{c}{half}") for c in ("n", "docs") for half in (0, 1)]
    words = materialise(counts.groupBy("name").agg(*by_half), "words")
    totals = words.agg(F.sum("n0"), F.sum("n1")).first()
    if totals[0] is None:
        return None
    grams = words.select("n0", "n1", F.explode(_letter_runs(F.concat(F.lit("^"), "name", F.lit("$")))).alias("gram"))
    grams = grams.groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow().to_pydict()
    known = words.where(F.col("docs0") + F.col("docs1") >= KNOWN_DOCS)
    table = known.select(F.xxhash64("name").alias("hash"), "n0", "n1", "docs0", "docs1").toArrow()
    hashes, n0, n1, docs0, docs1 = (column.to_numpy() for column in table.columns)

    def of(total: int, n: np.ndarray, docs: np.ndarray, runs: list[int]) -> Familiarity:
        held = docs >= KNOWN_DOCS
        return Familiarity(WordTable(hashes[held], n[held]), total, {g: c for g, c in zip(grams["gram"], runs, strict=True) if c})

    whole = of(sum(totals), n0 + n1, docs0 + docs1, [a + b for a, b in zip(grams["n0"], grams["n1"], strict=True)])
    halves = [of(totals[0], n0, docs0, grams["n0"]), of(totals[1], n1, docs1, grams["n1"])]
    # A half that no other can judge is judged by all.
    sent = spark.sparkContext.broadcast([halves[1], halves[0]] if all(h.total for h in halves) else [whole, whole])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        judges = sent.value
        for batch in batches:
            made = []
            for at, stop in slices(pc.binary_length(batch.column("text")).to_pylist(), SLICE_BYTES):
                part = batch.slice(at, stop - at)
                parts = [[], []]
                for text, half in zip(part.column("text").to_pylist(), part.column("half").to_pylist(), strict=True):
                    parts[half].append(text)
                made += [row for judge, texts in zip(judges, parts, strict=True) for row in judge.texts(texts)]
            mean, size, variance = zip(*made, strict=True) if made else ([], [], [])
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.float64()) for k, v in {"mean": mean, "size": size, "variance": variance}.items()})
        give_back()

    judged = materialise(rows.select("text", "half").mapInArrow(judge, "mean double, size double, variance double"), "judged")
    low, middle, high, spread, inverse = judged.agg(
        *[F.percentile(F.round("mean", 5), F.lit(x)) for x in (0.25, 0.5, 0.75)],
        F.sum(F.round(F.col("variance") * F.col("size"), 6).cast("decimal(38,6)")) / F.sum(F.round("size", 6).cast("decimal(38,6)")),
        F.percentile(F.round(1 / F.col("size"), 5), F.lit(0.5)),
    ).first()
    whole.center, whole.within = float(middle), float(spread) + 1e-6
    # The spread of texts as of a normal one with the same quartiles, less what their lengths explain.
    whole.apart = max(((high - low) / 1.349) ** 2 - whole.within * inverse, 1e-3)
    strange = (F.lit(whole.center) - F.col("mean")) / F.sqrt(F.lit(whole.apart) + F.lit(whole.within) / F.col("size"))
    whole.limit = max(10.0, 1.5 * float(judged.agg(F.percentile(F.round(strange, 5), F.lit(0.995))).first()[0]))
    return whole


def predict(docs: DataFrame, model: Field | None, text: str = "text", names: tuple[str, str, str] = ("__llm_lang", "__llm_score", "__llm_strange")) -> DataFrame:
    """All rows and columns of ``docs`` with language, score and strangeness (see ``label_texts``) as ``names``, from whole texts alone.

    Null texts and texts without a letter are ``und`` with score 0, as is everything without a
    model. Repeated rows come back one by one with equal results; an empty table stays empty. Long texts are
    read whole, one at a time. The names must not be columns of ``docs``. Nothing is shuffled; the model, of fixed size but for its lexicon
    and words, is sent to each executor once, and texts are cut into words once for all three results.
    """
    if model is None:
        return docs.select("*", F.lit(UNKNOWN).alias(names[0]), F.lit(0.0).alias(names[1]), F.lit(0.0).alias(names[2]))
    usual = model.usual
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.lexicon, model.weights, model.moves, usual))
    version = zlib.crc32(model.weights.tobytes()), usual and (usual.total, usual.center, usual.apart, usual.within, usual.limit)

    def label(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # What the steps before have freed goes back before the model is read.
        give_back()
        known = worker_state("language_field", lambda: Field(*sent.value), version)
        for batch in texts:
            made = [[], [], []]
            sizes = pc.binary_length(batch).fill_null(0).to_pylist()
            for at, stop in slices(sizes, SLICE_BYTES):
                for column, part in zip(made, label_texts(known, batch.slice(at, stop - at).to_pylist()), strict=True):
                    column += part
            yield pa.StructArray.from_arrays([pa.array(made[0], pa.string()), pa.array(made[1], pa.float64()), pa.array(made[2], pa.float64())], names=["lang", "score", "strange"])
        give_back()

    found = free_name(docs, "__llm_found")
    labelled = docs.withColumn(found, F.arrow_udf(label, "lang string, score double, strange double")(F.col(text)))
    fields = zip(("lang", "score", "strange"), names, strict=True)
    return labelled.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"{found}.{f}").alias(n) for f, n in fields])


def language_runs(docs: DataFrame, model: Field | None, keep: list[str], text: str = "text") -> DataFrame:
    """Where the whole texts of ``docs`` switch language: the columns ``keep``, then ``start, end, language, posterior, words`` of each run of words.

    See ``label_runs``; runs of one text do not overlap and hold all its words with a letter. Null texts and texts without such words have no
    runs, nor has anything without a model; repeated rows have theirs one by one; an empty table gives an empty result. The
    names of the runs' columns must not be among ``keep``. Nothing is shuffled.
    """
    kind = "struct<start: bigint, end: bigint, language: string, posterior: double, words: bigint>"
    if model is None:
        none = F.from_json(F.lit("[]"), f"array<{kind}>")
        return docs.select(*[F.col(f"`{c}`") for c in keep], F.inline(none))
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.lexicon, model.weights, model.moves))
    version = zlib.crc32(model.weights.tobytes())
    struct = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("language", pa.string()), ("posterior", pa.float64()), ("words", pa.int64())])

    def label(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = worker_state("language_runs", lambda: Field(*sent.value), version)
        for batch in texts:
            yield pa.array((label_runs(known, value.as_py()) for value in batch), pa.list_(struct))

    found = free_name(docs, "__llm_runs")
    labelled = docs.withColumn(found, F.arrow_udf(label, f"array<{kind}>")(F.col(text)))
    return labelled.select(*[F.col(f"`{c}`") for c in keep], F.inline(found))


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """All rows and columns of ``docs`` with ``__llm_lang`` and ``__llm_score``; see ``train`` and ``predict``."""
    return predict(docs, train(docs, doc_id, text, lang), text).drop("__llm_strange")


def in_known_language(docs: DataFrame, least: float = 0.3, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose words are as likely as those of learned languages, and of which one speaks at least this share.

    Code-switched texts stay, as their largest part passes; rejected are null texts, texts without a
    letter, texts whose words are spread over several languages, and texts far less likely than the
    labelled ones (see ``Familiarity``), as those in languages that were not learned and random letters are.
    Repeated rows are kept or rejected alike; without labelled documents, as of an empty table, all are rejected.
    """
    rows = labelled(docs, doc_id, text, lang)
    counts = counted(rows)
    model = learn(rows, counts)
    if model:
        model.usual = familiar(rows, counts)
    names = tuple(free_name(docs, n) for n in ("__llm_lang", "__llm_score", "__llm_strange"))
    found = predict(docs, model, text, names)
    limit = model.usual.limit if model and model.usual else 0.0
    kept = found.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least) & (F.col(names[2]) <= limit))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
