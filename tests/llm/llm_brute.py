"""Plain Python versions of the operators, and rows that are hard to handle."""

import re
from collections import Counter, defaultdict

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, _row string, kinds int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, langs=None):
    """A table of documents with further columns whose names operators use inside."""
    rows = [
        (i, t, (langs or {}).get(i, "en"), "src", None if t is None else len(t), f"k{i}", "r", 1)
        for i, t in (texts.items() if isinstance(texts, dict) else texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def prose(random, words, vocabulary=400):
    return " ".join(f"w{random.randrange(vocabulary)}x" for _ in range(words))


def hard_texts(random):
    """Null, empty, blank, one word, no letters, unusual characters, repeated rows, a very long text."""
    long = prose(random, 20_000, 5_000)
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "One"), (5, "12 34 #$%&"),
        (6, "Ünï çødé 你好 \U0001f389 é ΑΣ Σ  x"), (7, "a b c"), (7, "a b c"), (8, "A B C"),
        (9, long), (10, long + " end"), (11, "x" * 5_000), (None, "no id"), (12, "line\nline\n\nline \n"),
    ]


class Groups:
    """Union-find."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {p for i, w in enumerate(windows) if often[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(values, alike):
    """Smallest index reachable from each by ``alike`` pairs."""
    groups = Groups()
    for i, a in enumerate(values):
        groups.find(i)
        for j in range(i):
            if alike(a, values[j]):
                groups.join(i, j)
    return [groups.find(i) for i in range(len(values))]


def shingles(line):
    units = line.encode("utf-16-be")
    return {units[i : i + 16] for i in range(0, max(len(units) - 15, 1), 2)}


def line_keepers(texts):
    """(doc, line) to the first place of a line that similar lines connect it to."""
    places = [
        (i, n, line) for i, t in texts for n, line in enumerate((t or "").split("\n")) if WORD.search(line)
    ]
    first = {}
    for i, n, line in places:
        place = (-1 if i is None else i, n)
        first[line] = min(first.get(line, place), place)
    lines = list(first)
    sets = [shingles(line) for line in lines]
    roots = near_groups(sets, lambda a, b: 10 * len(a & b) >= 8 * len(a | b))
    best = defaultdict(lambda: (1 << 60, 0))
    for line, root in zip(lines, roots):
        best[root] = min(best[root], first[line])
    at = {line: best[root] for line, root in zip(lines, roots)}
    return {(i, n): at[line] for i, n, line in places}
