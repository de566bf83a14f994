"""Marked words of a SentencePiece model, and the forward pass over them.

Text is marked by writing ``▁`` for each space and one more in front.  No piece holds a ``▁`` after
another character, so no token crosses the start of a marked word and words are encoded alone.
Nor does one cross two characters that stand side by side in no piece (a letter and a comma, say):
a word is cut there into parts, of which there are fewer distinct ones, and parts are encoded alone.

The forward pass walks distinct parts in sorted order.  Each position of a part is a node of the
trie of the sorted parts; the state of a node (its best last piece, and how many tokens lead there)
is kept on a stack and reused by every following word with the same prefix.

* ``unigram`` models: the state is the best path by summed piece scores (plain Viterbi).
* ``bpe`` models: a path is allowed only where each two neighbouring pieces are what merging by
  rank would leave side by side; exactly one path into each node is allowed, which is the one that
  the merges give.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece

MARK = "▁"
_NO_PIECE = -1


class Model:
    """Pieces, scores and byte pieces of a SentencePiece file with an identity normalizer."""

    def __init__(self, path: str, kind: str = "bpe", most_pairs: int = 1_000_000):
        if kind not in ("bpe", "unigram"):
            raise ValueError(f"unknown kind of model: {kind}")
        self.kind, self.most_pairs = kind, most_pairs
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = lib.get_piece_size()
        self.byte_ids = [_NO_PIECE] * 256
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.unknown = lib.unk_id()
        self.out: list[bytes] = []
        for i in range(self.size):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.out.append(bytes([value]))
            elif lib.is_control(i):
                self.out.append(b"")
            elif lib.is_unknown(i):
                self.out.append(" ⁇ ".encode())
            else:
                self.out.append(piece.replace(MARK, " ").encode())
                if not lib.is_unused(i):
                    self.ids[piece] = i
                    self.rank[piece] = -lib.get_score(i)
        probe = "a  b Å\n c "
        if lib.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("only models that leave the text as it is are supported")
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece holds a word boundary inside")
        self.bytes_known = min(self.byte_ids) >= 0
        self.longest = max(map(len, self.ids), default=1)
        self.worst = max(self.rank.values(), default=0.0) + 10.0
        # no piece joins these to a neighbour, so they may stand as words of their own
        joined = set("".join(p for p in self.ids if len(p) > 1))
        alone = "".join(c for c in "\n\t\r" if c not in joined)
        end = f"|{MARK}+" + (f"|[{alone}]" if alone else "")
        self.pattern = re.compile(f"{MARK}*[^{MARK}{alone}]+{end}")
        sets = ["".join(map(re.escape, s)) for s in self._joined()]
        within = [f"[{s}]+" for s in sets] + [f"[^{MARK}{alone}{''.join(sets)}]+"]
        self.part_pattern = re.compile(f"{MARK}*(?:{'|'.join(within)}){end}")
        # every ending of a piece, with its id if it is a piece itself
        self.endings: dict[str, int] = {}
        for piece in self.ids:
            for k in range(1, len(piece)):
                self.endings.setdefault(piece[k:], _NO_PIECE)
        self.endings.update(self.ids)
        self._split: dict[str, tuple[str, str] | None] = {}
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}
        self._pairs: dict[int, bool] = {}
        self.piece_of = {i: p for p, i in self.ids.items()}

    def _joined(self, most: int = 8) -> list[list[str]]:
        """Sets of characters that pieces join, directly or by others; the ``most`` largest.

        Characters of two sets, or of a set and none of these, stand side by side in no piece.
        """
        near: dict[str, str] = {}

        def top(c: str) -> str:
            while near.setdefault(c, c) != c:
                near[c] = c = near[near[c]]
            return c

        for a, b in {piece[k : k + 2] for piece in map(str.lstrip, self.ids, repeat(MARK)) for k in range(len(piece) - 1)}:
            near[top(a)] = top(b)
        sets: dict[str, list[str]] = {}
        for c in sorted(near):
            sets.setdefault(top(c), []).append(c)
        return sorted(sets.values(), key=len, reverse=True)[:most]

    def words(self, text: str) -> list[str]:
        """Marked words in order; joined they are the marked text."""
        return self.pattern.findall(MARK + text.replace(" ", MARK)) if text else []

    def parts(self, text: str) -> list[str]:
        """Parts of the marked words in order; joined they are the marked text."""
        return self.part_pattern.findall(MARK + text.replace(" ", MARK)) if text else []

    # pieces as the merges build them

    def _merge(self, symbols: list[str]) -> tuple[list[str], dict]:
        """Merge by rank, leftmost first among equals; also how each merged symbol was split."""
        how: dict[str, tuple[str, str]] = {}
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                r = self.rank.get(symbols[k] + symbols[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if best is None:
                break
            both = symbols[at] + symbols[at + 1]
            how[both] = (symbols[at], symbols[at + 1])
            symbols[at : at + 2] = [both]
        return symbols, how

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the last merge of a piece joins; None for one character."""
        if len(piece) == 1:
            return None
        if piece not in self._split:
            left, how = self._merge(list(piece))
            # a piece that its own characters never merge to is no possible token
            self._split[piece] = how[piece] if len(left) == 1 else ("", "")
        return self._split[piece]

    def _edge(self, token: int, side: int) -> list[tuple[str, float]] | None:
        """Symbols on one edge of a token, from its character up, each with the rank that ends it."""
        chain, piece, end = [], self.piece_of[token], float("inf")
        while True:
            chain.append((piece, end))
            parts = self.split(piece)
            if parts is None:
                return chain[::-1]
            if parts == ("", ""):
                return None
            end, piece = self.rank[piece], parts[side]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the text of both tokens leaves just these two; left may be _NO_PIECE."""
        key = left * self.size + right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > self.most_pairs:
                self._pairs.clear()
            known = self._pairs[key] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        if left == _NO_PIECE:
            return self.split(self.piece_of[right]) != ("", "")
        if left not in self._right:
            self._right[left] = self._edge(left, 1)
        if right not in self._left:
            self._left[right] = self._edge(right, 0)
        a, b = self._right[left], self._left[right]
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            x, x_end = a[i]
            y, y_end = b[j]
            r = self.rank.get(x + y)
            if r is not None and r < x_end and r <= y_end:
                return False
            if i + 1 == len(a) and j + 1 == len(b):
                return True
            # the symbol that a merge takes first goes; of two equal merges the left comes first
            if x_end <= y_end and i + 1 < len(a):
                i += 1
            else:
                j += 1


class Trie:
    """Depth-first walk over sorted distinct words, keeping the states of the current prefix."""

    def __init__(self, model: Model):
        self.model = model
        self.word = ""
        # per prefix: last token (or _NO_PIECE after bytes), where it starts, tokens so far, score
        self.last, self.start, self.count, self.score = [_NO_PIECE], [0], [0], [0.0]

    def enter(self, word: str) -> None:
        """Make ``word`` the current path, computing only what the last word does not share."""
        old, shared = self.word, 0
        for x, y in zip(word, old):
            if x != y:
                break
            shared += 1
        keep = shared + 1
        del self.last[keep:], self.start[keep:], self.count[keep:], self.score[keep:]
        self.word = word
        if self.model.kind == "bpe":
            self._walk_bpe(keep)
        else:
            for end in range(keep, len(word) + 1):
                self._step_unigram(end)

    def _put(self, token: int, start: int, count: int, score: float) -> None:
        self.last.append(token)
        self.start.append(start)
        self.count.append(count)
        self.score.append(score)

    def _fallback(self, end: int) -> None:
        self._put(_NO_PIECE, end - 1, self.count[end - 1] + self._bytes(end), self.score[end - 1] - self.model.worst)

    def _walk_bpe(self, first: int) -> None:
        model, word, last, begin, count = self.model, self.word, self.last, self.start, self.count
        ending, pair, size = model.endings.get, model._pairs.get, model.size
        for end in range(first, len(word) + 1):
            # only one token fits, whatever is tried first: most often the last one and this character
            start = begin[end - 1]
            token = ending(word[start:end], _NO_PIECE)
            if token >= 0:
                fit = pair(last[start] * size + token)
                if fit is None:
                    fit = model.fits(last[start], token)
                if fit:
                    last.append(token)
                    begin.append(start)
                    count.append(count[start] + 1)
                    continue
            for start in range(end - 1, -1, -1):
                token = ending(word[start:end])
                if token is None:
                    start = -1
                    break
                if token >= 0:
                    before = last[start]
                    fit = pair(before * size + token)
                    if fit is None:
                        fit = model.fits(before, token)
                    if fit:
                        last.append(token)
                        begin.append(start)
                        count.append(count[start] + 1)
                        break
            else:
                start = -1
            if start < 0:
                last.append(_NO_PIECE)
                begin.append(end - 1)
                count.append(count[end - 1] + self._bytes(end))

    def _bytes(self, end: int) -> int:
        return len(self.word[end - 1].encode()) if self.model.bytes_known else 1

    def _step_unigram(self, end: int) -> None:
        best, at, token = None, 0, _NO_PIECE
        for start in range(max(0, end - self.model.longest), end):
            found = self.model.ids.get(self.word[start:end])
            if found is not None:
                score = self.score[start] - self.model.rank[self.word[start:end]]
                if best is None or score > best:
                    best, at, token = score, start, found
        if best is None or (
            not self.model.bytes_known and self.score[end - 1] - self.model.worst > best
        ):
            self._fallback(end)
        else:
            self._put(token, at, self.count[at] + 1, best)

    def tokens(self) -> list[int]:
        """Token ids of the current word, read back from its last position."""
        out: list[int] = []
        last, begin, end = self.last, self.start, len(self.word)
        while end:
            start, token = begin[end], last[end]
            if token != _NO_PIECE:
                out.append(token)
            elif self.model.bytes_known:
                out.extend(self.model.byte_ids[b] for b in reversed(self.word[start:end].encode()))
            else:
                out.append(self.model.unknown)
            end = start
        return out[::-1]


class WordTable:
    """What the forward pass gave for each distinct word seen by this Python worker.

    ``values`` is asked once per new word, with the trie standing at that word.  The table is emptied once
    it holds ``most`` words, or 16 times as many letters and values together.  Words of more than 64 letters
    (text without spaces) are walked but not remembered.  Results do not depend on any of that.
    """

    LONG = 64

    def __init__(self, model: Model, values, most: int = 1_200_000):
        self.model, self.values, self.most = model, values, most
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.letters = 0
        self.flat = np.empty(0, np.int32)
        self.begin = np.zeros(1, np.int64)

    def _add(self, new: list[str]) -> None:
        trie, values, flat, ends = Trie(self.model), self.values, array("i"), []
        for word in new:
            trie.enter(word)
            flat.extend(values(trie))
            ends.append(len(flat))
        self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
        self.flat = np.concatenate([self.flat, np.frombuffer(flat, np.int32)])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.array(ends, np.int64)])

    def _forget(self, words: list[str]) -> None:
        """Take out the words that were added last."""
        for word in words:
            del self.row[word]
        self.begin = self.begin[: len(self.row) + 1]
        self.flat = self.flat[: self.begin[-1]].copy()

    def _learn(self, distinct: list[str]) -> tuple[np.ndarray, list[str]]:
        """The row of each of these sorted words; the long ones among them, which are to be forgotten."""
        long = [w for w in distinct if len(w) > self.LONG]
        new = [w for w in distinct if w not in self.row and len(w) <= self.LONG]
        held = self.letters + len(self.flat) + 2 * sum(map(len, new))
        if (len(self.row) + len(new) > self.most or held > 16 * self.most) and self.row:
            self._clear()
            new = [w for w in distinct if len(w) <= self.LONG]
        if new:
            self._add(new)
            self.letters += sum(map(len, new))
        if long:
            self._add(long)
        return np.fromiter(map(self.row.__getitem__, distinct), np.int64, len(distinct)), long

    def _gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, size = self.begin[rows], self.begin[rows + 1] - self.begin[rows]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(first - (ends - size), size)], size

    def lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Values of all words, end to end, and how many each word has."""
        distinct, (codes,) = _coded([pa.array(words, pa.string())])
        rows, long = self._learn(distinct)
        found = self._gather(rows[codes])
        if long:
            self._forget(long)
        return found

    def read(self, texts, most_chars: int = 8_000_000):
        """Per run of texts: the parts of each text, the values of all parts, end to end, and how many each part has.

        The new parts of about ``most_chars`` are walked together: they share more prefixes than those of a run.
        """
        for group in runs(texts, most_chars):
            sizes, words = [], []
            for run in runs(group):
                parts = [self.model.parts(t) for t in run]
                sizes.append(np.fromiter(map(len, parts), np.int64, len(parts)))
                words.append(pa.array(list(chain.from_iterable(parts)), pa.string()))
            distinct, codes = _coded(words)
            del words
            rows, long = self._learn(distinct)
            del distinct
            for size, code in zip(sizes, codes):
                yield size, *self._gather(rows[code])
            if long:
                self._forget(long)


def _coded(words: list[pa.Array]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct words in the order of their code points, and which of them each word is."""
    found = pa.concat_arrays(words).dictionary_encode()
    order = pc.array_sort_indices(found.dictionary)
    place = np.empty(len(order), np.int32)
    place[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
    distinct = found.dictionary.take(order).to_numpy(zero_copy_only=False).tolist()
    return distinct, np.split(place[found.indices.to_numpy()], np.cumsum([len(w) for w in words])[:-1])


def runs(texts, most_chars: int = 1_000_000):
    """Consecutive texts of a batch, at most about ``most_chars`` at a time; at least one text."""
    run, chars = [], 0
    for text in texts:
        if run and chars + len(text) > most_chars:
            yield run
            run, chars = [], 0
        run.append(text)
        chars += len(text)
    if run:
        yield run


@lru_cache(maxsize=4)
def load(path: str, kind: str = "bpe") -> Model:
    """One model per Python worker."""
    return Model(path, kind)
