"""Ids of texts from the ids of their words, each distinct word encoded once."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from itertools import chain, repeat
from types import ModuleType
from typing import Any

import numpy as np

#: Distinct words that are remembered and the longest of them; neither changes a result.
REMEMBERED, LONGEST = 800_000, 64

#: Words in any order, their ids in a row, how many each has, and a mark for each.
Encoded = tuple[list[str], np.ndarray, np.ndarray, np.ndarray]
Encoder = Callable[[list[str]], Encoded]


def worker_kept(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once per Python worker and key.

    Functions reach a worker by value, so their globals end with a task; the worker itself serves
    many tasks, and what it has learned about words is the same for all of them.
    """
    kept = sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def of_file(kind: Callable[[str], Any], path: str) -> Any:
    """``kind(path)``, made once per Python worker and state of the file."""
    state = os.stat(path)
    key = f"{kind.__name__} {path} {state.st_size} {state.st_mtime_ns}"
    return worker_kept(key, lambda: kind(path))


class WordCache:
    """Texts as lists of words to ids; ``encode`` gives the ids of words and a mark for each."""

    def __init__(self, encode: Encoder):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.count = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        #: Word i has the ids from ``bounds[i]`` to ``bounds[i + 1]``.
        self.bounds = np.zeros(1 << 16, np.int64)
        self.marks = np.zeros(1 << 16, bool)

    def _learn(self, words: list[str]) -> None:
        words, ids, lengths, marks = self.encode(words)
        first, count = self.count, len(words)
        start = self.bounds[first]
        ends = start + np.cumsum(lengths)
        while first + count + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
            self.marks = np.concatenate([self.marks, np.zeros_like(self.marks)])
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[start : ends[-1]] = ids
        self.bounds[first + 1 : first + count + 1] = ends
        self.marks[first : first + count] = marks
        self.known.update(zip(words, range(first, first + count)))
        self.count += count

    def __call__(self, texts: list[list[str]]) -> list[tuple[np.ndarray, bool]]:
        """(ids, all words marked) of each text; the new words of all texts are encoded together."""
        if self.count > REMEMBERED or self.bounds[self.count] > 16 * REMEMBERED:
            self.clear()
        words = list(chain.from_iterable(texts))
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missed = np.flatnonzero(at < 0).tolist()
        if missed:
            new = list(dict.fromkeys(words[i] for i in missed))
            self._learn(new)
            at[missed] = [self.known[words[i]] for i in missed]
            for word in new:
                if len(word) > LONGEST:
                    del self.known[word]
        starts = self.bounds[at]
        lengths = self.bounds[at + 1] - starts
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
        ids = self.ids[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
        marks = self.marks[at]
        found, first = [], 0
        for text in texts:
            last = first + len(text)
            found.append((ids[ends[first] : ends[last]], bool(marks[first:last].all())))
            first = last
        return found


def flat(ids: list[list[int]], marks: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What an encoder returns, from a list of ids per word."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    row = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
    return row, lengths, np.ones(len(ids), bool) if marks is None else np.array(marks, bool)
