"""URL filter: all glob rules at once by a bit-parallel wildcard automaton.

Every rule becomes a row of states, one per literal character, packed side by side into
64-bit words.  One step reads the next byte of every URL of a batch: shift the state bits,
keep those whose literal fits the byte (Shift-And), and add the bits of states behind a
wildcard that accepts the byte.  The work is bytes x words, whatever the rules look like.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.llm.storage import unused

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """``pattern`` is a host, which stands for its subdomains too, and the start of a path.

    ``*`` stands for any run (within the host, or within the path), ``?`` for one byte.
    """

    pattern: str
    verdict: str


class Automaton:
    """Shift-And masks of many patterns, anchored at both ends of ``.host/path``."""

    def __init__(self, patterns: Sequence[str]):
        literals: list[np.ndarray | None] = []  # the byte set that leads into a state
        loops: list[np.ndarray] = []  # the byte set that keeps a state
        self.first, self.last = [], []
        anything = np.ones(256, bool)
        in_host = anything.copy()
        in_host[ord("/")] = False
        for pattern in patterns:
            host, slash, path = pattern.partition("/")
            self.first.append(len(literals))
            literals.append(None)
            loops.append(in_host.copy())  # the labels of any subdomain
            for part, wild in ((f".{host}", in_host), (slash + path + "*", anything)):
                for byte in part.encode():
                    if byte == ord("*"):
                        loops[-1] = loops[-1] | wild
                        continue
                    literal = np.zeros(256, bool)
                    if byte == ord("?"):
                        literal |= wild
                    else:
                        literal[byte] = True
                    literals.append(literal)
                    loops.append(np.zeros(256, bool))
            self.last.append(len(literals) - 1)
        self.words = max(1, -(-len(literals) // 64))
        self.enter = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for state, (literal, loop) in enumerate(zip(literals, loops, strict=True)):
            word, bit = state // 64, np.uint64(1 << (state % 64))
            if literal is None:
                self.start[word] |= bit
            else:
                self.enter[literal, word] |= bit
            self.stay[loop, word] |= bit

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """Texts x patterns: which pattern fits which whole text."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        offset = (np.cumsum(lengths) - lengths)[order]
        active = len(texts) - np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), side="right")
        bits = np.tile(self.start, (len(texts), 1))
        for at, n in enumerate(active):  # the longest n texts still have a byte here
            now, byte = bits[:n], data[offset[:n] + at]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            bits[:n] = moved & self.enter[byte] | now & self.stay[byte]
        found = np.empty((len(texts), len(self.last)), bool)
        for k, state in enumerate(self.last):
            found[order, k] = bits[:, state // 64] >> np.uint64(state % 64) & np.uint64(1) != 0
        return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def filter_urls(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` to every row.

    The longest fitting pattern wins, the earlier of equally long ones.  A URL that no rule
    fits gets ``default``.  Null URLs and URLs without ``://`` have an empty host and path.
    Columns of the input with these four names are replaced.
    """
    ranked = sorted(range(len(rules)), key=lambda i: -len(rules[i].pattern))
    automaton = Automaton([rules[i].pattern for i in ranked])

    @F.pandas_udf("int")
    def fitting(canonical: pd.Series) -> pd.Series:
        found = automaton.matches([t.encode() for t in canonical])
        return pd.Series(np.where(found.any(axis=1), found.argmax(axis=1), -1) if len(rules) else np.full(len(canonical), -1))

    out = pages.drop(*[c for c in pages.columns if c.lower() in ("host", "path", "rule", "verdict") and c != url_col])
    at = unused("_fit", out)
    host, path = host_and_path(F.col(url_col))
    judged = out.withColumns({"host": host, "path": path}).withColumn(at, fitting(F.concat(F.lit("."), "host", "path")))
    names = F.array(*[F.lit(rules[i].pattern) for i in ranked]).cast("array<string>")
    verdicts = F.array(*[F.lit(rules[i].verdict) for i in ranked]).cast("array<string>")
    fit = F.when(F.col(at) >= 0, F.col(at))
    return judged.withColumns(
        {"rule": F.get(names, fit), "verdict": F.coalesce(F.get(verdicts, fit), F.lit(default))}
    ).drop(at)
