"""Secret scans by a linear-chain conditional random field over tokens.

Three patterns give the base spans. A field with the labels outside, begin and inside then tags the
tokens of every line from their shape, the neighbouring words and features of the whole text, and Viterbi
decoding gives further spans. The field is trained here on windows around base spans of the
corpus itself and on as many windows without any: a fixed number of windows, chosen by hash.

Relabelling a whole secret as outside loses its tokens' gains over outside and what its transitions
gain over staying outside. Where no run of tokens around a token can gain anything, by sums of upper
bounds, the token is outside on the best path. Only the short chains between such tokens are
decoded, with the same result as decoding all. Line ends are tokens that are always outside. Scores
of a word are remembered, which makes most tokens a lookup.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import plain_names, stored, texts

#: The base patterns, in order of kind.
KINDS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
#: A quick look for runs that are long enough; a run of 32 lies in a run that the pattern finds whole.
HEX = re.compile(r"[0-9a-f]{32,}")
#: Training windows of each sort, tokens to each side, passes, step of the gradient, pull to zero.
WINDOWS, CONTEXT, PASSES, STEP, PULL = 400, 8, 12, 0.3, 1e-4
#: Words a task remembers, how much of a word its features look at.
REMEMBERED, LONGEST = 200_000, 64
#: Code points tagged at a time; a longer text is cut at the next white space, which ends a chain.
PORTION = 1 << 18
#: Score of a label that may not follow another: inside after outside.
FORBIDDEN = -20.0
OUT, BEGIN, INSIDE = 0, 1, 2

TOKEN = re.compile(r"[^\W_]+(?:[+/_.-]+[^\W_]+)*|[^\w\s]|_+|\n")
BREAK = re.compile(r"\s")
#: Lower-case words without which the first pattern cannot match.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
HINT = re.compile(r"pass|secret|token|key|auth|cred|pwd", re.IGNORECASE)

Span = tuple[int, int, str]


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Base spans by kind: leftmost, non-overlapping, in code points."""
    assign = [m.span() for m in _assigned(text)]
    access = [m.span() for m in KINDS["access"].finditer(text) if m.end() - m.start() >= 16]
    return {"assign": assign, "access": access, "hex": [m.span() for m in HEX.finditer(text)]}


def _assigned(text: str) -> list[re.Match]:
    low = text.lower()
    if not any(name in low for name in NAMES):
        return []
    return [m for m in KINDS["assign"].finditer(text) if m.end(2) - m.start(2) >= 8]


class Sorts(dict):
    """Code points to sorts of characters, worked out as they come."""

    def __missing__(self, point: int) -> str:
        char = chr(point)
        self[point] = "d" if char.isdigit() else "u" if char.isupper() else "l" if char.isalpha() else char
        return self[point]


SORTS = Sorts()


def look(word: str) -> tuple[str, bool, bool]:
    """Sorts of a word's characters, whether it hints at a secret and whether it is hexadecimal."""
    start = word[:LONGEST]
    hexadecimal = len(start) >= 8 and not start.strip("0123456789abcdefABCDEF")
    return start.translate(SORTS), HINT.search(start) is not None, hexadecimal


def look_features(seen: tuple[str, bool, bool]) -> tuple[list[str], list[str], list[str]]:
    """Features of a look for the word's own label, for the next one and for the one before."""
    sorts, hint, hexadecimal = seen
    if sorts == "\n":
        return [], [], []
    changes = sum(a != b for a, b in zip(sorts, sorts[1:]))
    shape = f"{''.join(dict.fromkeys(sorts))}|{min(len(sorts), 40) // 4}|{min(changes, 12) // 2}"
    own = [f"own {shape}", f"hint {hint}", f"hex {hexadecimal} {len(sorts) // 8}"]
    return own, [f"after {shape}", f"after hint {hint}"], [f"before {shape}"]


def name_features(word: str) -> tuple[str, str]:
    """Features of the word itself for the next label and for the one before."""
    name = word[:LONGEST].lower()
    return f"after word {name}", f"before word {name}"


def word_features(word: str) -> tuple[list[str], list[str], list[str]]:
    own, after, before = look_features(look(word))
    following, leading = name_features(word)
    return (own, [*after, following], [*before, leading]) if own else (own, after, before)


def file_features(text: str) -> list[str]:
    """What the whole text looks like: digits, symbols and length of lines."""
    length = max(1, len(text))
    digits = sum(map(text.count, "0123456789")) * 50 // length
    symbols = sum(map(text.count, "={}();\"")) * 50 // length
    lines = len(text) // (text.count("\n") + 1)
    return [f"digits {min(digits, 5)}", f"symbols {min(symbols, 5)}", f"lines {min(lines, 400) // 50}"]


def _log_sum(scores: np.ndarray, axis: int) -> np.ndarray:
    top = scores.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(scores - top).sum(axis=axis))


class Field:
    """Weights of features by label, and of transitions between labels."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.weights = np.zeros((0, 3))
        self.moves = np.zeros((3, 3))
        self.moves[OUT, INSIDE] = FORBIDDEN

    def score(self, features: list[str]) -> np.ndarray:
        """Weights of features by label; features that training has not seen weigh nothing."""
        return self.weights[[self.index[f] for f in features if f in self.index]].sum(axis=0)

    def train(self, windows: list[tuple[list[list[str]], list[int]]]) -> None:
        """Windows of (features, label) per token; steps along the likelihood's gradient."""
        for features, _ in windows:
            for f in (f for token in features for f in token):
                self.index.setdefault(f, len(self.index))
        count = len(self.index)
        self.weights, squares = np.zeros((count, 3)), np.full((count, 3), 1e-6)
        move_squares = np.full((3, 3), 1e-6)
        numbered = [([[self.index[f] for f in x] for x in features], labels) for features, labels in windows]
        for _ in range(PASSES):
            for slots, labels in numbered:
                gradient, moves = self._gradient(slots, labels)
                flat = np.array([s for x in slots for s in x], np.int64)
                rows = np.repeat(gradient, [len(x) for x in slots], axis=0)
                used, where = np.unique(flat, return_inverse=True)
                change = np.zeros((len(used), 3))
                np.add.at(change, where, rows)
                change -= PULL * self.weights[used]
                squares[used] += change**2
                self.weights[used] += STEP * change / np.sqrt(squares[used])
                move_squares += moves**2
                self.moves += STEP * moves / np.sqrt(move_squares)
                self.moves[OUT, INSIDE] = FORBIDDEN

    def _gradient(self, slots: list[list[int]], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Observed minus expected labels per token and transitions, by forward and backward sums."""
        scores = np.array([self.weights[x].sum(axis=0) for x in slots])
        count = len(scores)
        ahead, back = np.zeros_like(scores), np.zeros_like(scores)
        ahead[0], back[-1] = scores[0] + self.moves[OUT], self.moves[:, OUT]
        for i in range(1, count):
            ahead[i] = scores[i] + _log_sum(ahead[i - 1][:, None] + self.moves, 0)
        for i in range(count - 2, -1, -1):
            back[i] = _log_sum(self.moves + (scores[i + 1] + back[i + 1])[None, :], 1)
        whole = _log_sum(ahead[-1] + back[-1], 0)
        gradient = -np.exp(ahead + back - whole)
        gradient[np.arange(count), labels] += 1
        moves = np.zeros((3, 3))
        moves[OUT] += gradient[0]
        moves[:, OUT] += gradient[-1]
        for i in range(1, count):
            moves -= np.exp(ahead[i - 1][:, None] + self.moves + (scores[i] + back[i])[None, :] - whole)
            moves[labels[i - 1], labels[i]] += 1
        return gradient, moves

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Best labels of one chain between outside tokens (Viterbi)."""
        best, came = scores[0] + self.moves[OUT], []
        for row in scores[1:]:
            paths = best[:, None] + self.moves
            came.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        labels = [int((best + self.moves[:, OUT]).argmax())]
        for step in reversed(came):
            labels.append(int(step[labels[-1]]))
        return np.array(labels[::-1])


class Tagger:
    """Decodes texts, remembering the scores of words."""

    def __init__(self, field: Field) -> None:
        self.field = field
        #: What a transition gains over staying outside at most.
        self.gain = max(0.0, float(field.moves.max() - field.moves[OUT, OUT]))
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {"\n": 0}
        self.looks: dict[tuple, np.ndarray] = {}
        self.table = np.zeros((1024, 9))

    def _score(self, word: str) -> np.ndarray:
        seen = look(word)
        scores = self.looks.get(seen)
        if scores is None:
            scores = np.concatenate([self.field.score(x) for x in look_features(seen)])
            self.looks[seen] = scores
        following, leading = (self.field.index.get(f) for f in name_features(word))
        if following is None and leading is None:
            return scores
        scores = scores.copy()
        for at, slot in ((3, following), (6, leading)):
            if slot is not None:
                scores[at : at + 3] += self.field.weights[slot]
        return scores

    def ids(self, words: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.clear()
        known = self.known
        if new := [w for w in dict.fromkeys(words) if w not in known]:
            first = len(known)
            while first + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[first : first + len(new)] = list(map(self._score, new))
            known.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def labels(self, words: list[str], extra: np.ndarray) -> np.ndarray:
        """Labels of the tokens of one portion."""
        at = self.ids(words)
        rows = self.table[at]
        scores = rows[:, :3] + extra
        scores[1:] += rows[:-1, 3:6]
        scores[:-1] += rows[1:, 6:]
        scores[at == 0, OUT] += 1e6
        labels = np.zeros(len(words), np.int64)
        sums = np.r_[0, np.cumsum(scores[:, 1:].max(axis=1) - scores[:, OUT] + self.gain)]
        most = np.maximum.accumulate(sums[:0:-1])[::-1] - np.minimum.accumulate(sums[:-1])
        maybe = np.flatnonzero((most + self.gain > -1e-6) & (at > 0))
        for run in np.split(maybe, np.flatnonzero(np.diff(maybe) > 1) + 1):
            if len(run):
                labels[run] = self.field.decode(scores[run])
        return labels

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Begin and end of the secrets that the field sees in a whole text."""
        extra = self.field.score(file_features(text))
        found: list[tuple[int, int]] = []
        for at, part in _portions(text):
            words = TOKEN.findall(part)
            labels = self.labels(words, extra) if words else np.zeros(0, np.int64)
            if labels.any():
                found += _spans(labels, [m.span() for m in TOKEN.finditer(part)], at)
        return found


def _portions(text: str) -> Iterator[tuple[int, str]]:
    """A text with its position, cut at white space if it is long."""
    at = 0
    while len(text) - at > PORTION:
        cut = BREAK.search(text, at + PORTION)
        if not cut:
            break
        yield at, text[at : cut.start()]
        at = cut.start()
    yield at, text[at:]


def _spans(labels: np.ndarray, places: list[tuple[int, int]], at: int) -> list[tuple[int, int]]:
    """Runs of a begin and its insides."""
    spans: list[tuple[int, int]] = []
    for label, (start, end) in zip(labels, places):
        if label == BEGIN:
            spans.append((at + start, at + end))
        elif label == INSIDE and spans:
            spans[-1] = (spans[-1][0], at + end)
    return spans


def _windows(text: str) -> Iterator[tuple[bool, list[str], list[int]]]:
    """Training windows of a text: one per secret value, and one elsewhere, placed by the text's hash."""
    spans = base_spans(text)
    values = [m.span(2) for m in _assigned(text)]
    values = sorted(set(values) | set(spans["access"]) | set(spans["hex"]))
    pick = zlib.crc32(text.encode("utf-8", "surrogatepass")) % max(1, len(text))
    for start, end in [*values, (pick, pick)]:
        low, high = max(0, start - 12 * CONTEXT), end + 12 * CONTEXT
        line = text.rfind("\n", low, start) + 1 or low
        stop = text.find("\n", end, high)
        part = text[line : stop if stop >= 0 else high]
        words, labels = [], []
        for m in TOKEN.finditer(part):
            a, b = line + m.start(), line + m.end()
            inside = next(((x, y) for x, y in values if a < y and b > x), None)
            words.append(m.group())
            first = inside and not (labels and labels[-1] and a > inside[0])
            labels.append(OUT if not inside else BEGIN if first else INSIDE)
        if words:
            yield any(labels), words, labels


def training_windows(docs: DataFrame, windows: int = WINDOWS) -> DataFrame:
    """``secret, rank, words, labels, file``: windows of all documents; ``rank`` is a hash of the words.

    Of each sort, a task keeps those of the ``windows`` smallest ranks, each different one once.
    """
    schema = "secret boolean, rank long, words array<string>, labels array<long>, file array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bool, dict[int, tuple]] = {True: {}, False: {}}
        bound = {True: 1 << 63, False: 1 << 63}
        for batch in batches:
            for value in batch.column(1):
                text = value.as_py() or ""
                for secret, words, labels in _windows(text):
                    rank = xxhash.xxh64_intdigest("\x1f".join(words).encode("utf-8", "surrogatepass")) >> 1
                    if rank < bound[secret]:
                        best[secret].setdefault(rank, (secret, rank, words, labels, file_features(text)))
            for secret, found in best.items():
                smallest = sorted(found)[:windows]
                best[secret] = {rank: found[rank] for rank in smallest}
                if len(smallest) == windows:
                    bound[secret] = smallest[-1] + 1
        rows = [row for found in best.values() for row in found.values()]
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.bool_(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["secret", "rank", "words", "labels", "file"]
        )

    return texts(docs).mapInArrow(run, schema)


def trained(docs: DataFrame, windows: int = WINDOWS) -> Field:
    """A field trained on at most ``windows`` windows with and as many without a secret.

    Windows come from all documents, each different one once; those of the smallest hashes are
    taken. Without any windows nothing is tagged.
    """
    found = stored(training_windows(docs, windows), "windows").dropDuplicates(["secret", "rank"])
    rows = []
    for secret in (True, False):
        some = found.where(F.col("secret") == secret).orderBy("rank").limit(windows)
        rows += some.collect()
    field = Field()
    field.train([(_features(r["words"], r["file"]), r["labels"]) for r in sorted(rows, key=lambda r: r["rank"])])
    return field


def _features(words: list[str], file: list[str]) -> list[list[str]]:
    """Features of each token of a window."""
    parts = [word_features(w) for w in words]
    return [
        own + file + (parts[i - 1][1] if i else []) + (parts[i + 1][2] if i + 1 < len(parts) else [])
        for i, (own, _, _) in enumerate(parts)
    ]


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, kinds, starts, ends``: all spans of every whole text by start, then kind.

    Base spans stay as they are; a span of the field is added, as kind ``field``, if it touches none.
    A null text is empty. Positions are code points, ends exclusive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field)
        for batch in batches:
            rows = [_all_spans(value.as_py() or "", tagger) for value in batch.column(1)]
            spans = [
                pa.array([[span[at] for span in row] for row in rows], pa.list_(kind))
                for at, kind in ((2, pa.string()), (0, pa.int64()), (1, pa.int64()))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *spans], ["doc_id", "kinds", "starts", "ends"])

    return texts(docs).mapInArrow(
        run, "doc_id long, kinds array<string>, starts array<long>, ends array<long>"
    )


def _all_spans(text: str, tagger: Tagger) -> list[Span]:
    base = base_spans(text)
    spans = [(a, b, kind) for kind in KINDS for a, b in base[kind]]
    taken = _merged(spans)
    starts = [a for a, _ in taken]
    for a, b in tagger.spans(text):
        left = bisect.bisect_left(starts, b) - 1  # the last base span that begins before the end
        if left < 0 or taken[left][1] <= a:
            spans.append((a, b, "field"))
    order = [*KINDS, "field"].index
    return sorted(spans, key=lambda s: (s[0], order(s[2])))


def _merged(spans: list[Span]) -> list[tuple[int, int]]:
    """Spans as disjoint stretches in order."""
    merged: list[tuple[int, int]] = []
    for a, b, _ in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def redacted(docs: DataFrame, field: Field, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; ``n_chars``, if there, counts the new text.

    Texts without a span and null texts stay as they are, as do all other columns.
    """
    names = docs.columns
    kinds = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field)
        at = names.index("text")
        for batch in batches:
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            new = [t and _replaced(t, _merged(_all_spans(t, tagger)), mark) for t in old]
            columns[at] = pa.array(new, columns[at].type)
            if "n_chars" in names:
                place = names.index("n_chars")
                counts = [n if a == b else len(b) for n, a, b in zip(columns[place].to_pylist(), old, new)]
                columns[place] = pa.array(counts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, kinds)


def _replaced(text: str, stretches: list[tuple[int, int]], mark: str) -> str:
    parts, at = [], 0
    for a, b in stretches:
        parts += [text[at:a], mark]
        at = b
    return "".join([*parts, text[at:]])


@plain_names
def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced, by a field trained on them."""
    return redacted(docs, trained(docs))


def secrets_query(docs: DataFrame) -> DataFrame:
    """Counts and spans of every document by the contract of the query."""
    found = scan(docs, trained(docs)).withColumn(
        "span", F.arrays_zip(F.col("kinds").alias("kind"), F.col("starts").alias("start"), F.col("ends").alias("end"))
    )

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("span", lambda s: s["kind"] != "field")
    def number(kind):
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("span")).alias("spans")
    )
