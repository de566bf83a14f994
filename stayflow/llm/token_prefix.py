"""Token counts by prefix dynamic programming.

For each distinct part of a marked word the forward pass of ``pieces`` gives the number of tokens of
every prefix.  No token crosses a part, so the exact token count of any prefix of a text is the count
of the parts before it plus one entry of the table of the part it ends in.  From these counts the
longest prefix within a budget, or the count of a truncated text, is read without encoding again.

Edge cases: a null text counts as empty and has zero tokens, an empty array of prefix counts, and
keeps zero code points under any budget.  Counts need not rise with the prefix (one more character
can merge tokens); ``cut`` is the longest prefix that fits.  Texts are counted whole, without
begin or end tokens.  Rows are taken one by one, so repeated rows give repeated results.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from stayflow.llm.pieces import Trie, WordTable, load
from stayflow.llm.sentencepiece_codec import _ragged


def _counts(trie: Trie) -> list[int]:
    return trie.count[1:]


@lru_cache(maxsize=4)
def _table(path: str, kind: str) -> WordTable:
    return WordTable(load(path, kind), _counts)


def prefix_counts_of(texts: list[str], path: str, kind: str = "bpe") -> list[np.ndarray]:
    """For each text, the tokens of its prefixes of 1, 2, ... code points."""
    out: list[np.ndarray] = []
    for parts, inside, sizes in _table(path, kind).read(texts):
        ends = np.cumsum(sizes)
        at = 0  # part
        whole = inside[ends - 1].astype(np.int64) if len(ends) else ends
        before = np.cumsum(whole) - whole
        for n in parts.tolist():
            if not n:
                out.append(np.empty(0, np.int32))
                continue
            a, b = at, at + n
            base = np.repeat(before[a:b] - before[a], sizes[a:b])
            got = inside[ends[a] - sizes[a] : ends[b - 1]] + base
            out.append(got[1:].astype(np.int32))  # the first entry is the mark put in front
            at = b
    return out


def prefix_counts(text: Column | str, path: str, kind: str = "bpe") -> Column:
    """Column (array<int>): entry k is the token count of the first k + 1 code points."""

    @F.arrow_udf("array<int>")
    def counts(values: pa.Array) -> pa.Array:
        return _ragged(prefix_counts_of([t or "" for t in values.to_pylist()], path, kind))

    return counts(text)


def longest_within(counts: Column, budget: int | Column) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens, from prefix counts."""
    fits = F.transform(counts, lambda c, i: F.when(c <= budget, i + 1).otherwise(0))
    return F.coalesce(F.array_max(fits), F.lit(0))


def tokens_of_prefix(counts: Column, length: int | Column) -> Column:
    """Token count of the first ``length`` code points (all, if there are fewer)."""
    size = F.least(F.size(counts), F.lit(length) if isinstance(length, int) else length)
    return F.when(size > 0, F.element_at(counts, size)).otherwise(0)


def token_budget(text: Column | str, path: str, budget: int, kind: str = "bpe") -> Column:
    """Struct of ``n_tokens`` and ``cut``, the code points of the longest prefix within the budget.

    The same answers as from ``prefix_counts``, taken in the task so that the counts need not leave it.
    """

    @F.arrow_udf("n_tokens long, cut long")
    def answers(values: pa.Array) -> pa.Array:
        total, cut = [], []
        for counts in prefix_counts_of([t or "" for t in values.to_pylist()], path, kind):
            total.append(int(counts[-1]) if len(counts) else 0)
            if not len(counts) or total[-1] <= budget:
                cut.append(len(counts))
            else:
                fit = np.flatnonzero(counts <= budget)
                cut.append(int(fit[-1]) + 1 if len(fit) else 0)
        return pa.StructArray.from_arrays(
            [pa.array(total, pa.int64()), pa.array(cut, pa.int64())], ["n_tokens", "cut"]
        )

    return answers(text)
