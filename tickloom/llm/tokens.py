"""Token ids of whole texts by a public byte-level tokenizer file, each distinct word encoded once per worker.

A byte-level tokenizer's pattern never joins characters over these cuts: before the single space in front of a word,
and around a single line end between two words. Ids of a text are therefore the ids of its words, one by one, each
with its leading space if it has one. Texts with any other white space, or with a word longer than LONGEST bytes, go to the
library whole.

Words of all texts of a slice are told apart in numpy: by a 64-bit hash of their bytes and what stands before them, checked
against length and first eight bytes of the word that has the hash. Their ids lie in one array, from which those of
each text are gathered.
"""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd

from tickloom.llm.nearcopies import BASE, INVERSE, mixed, odd_numbers, powers
from tickloom.session import ship

ship(__name__)

#: Words that a worker keeps; later ones are encoded anew in each slice. Results don't depend on it.
REMEMBERED = 750_000
#: A mark at the end of a word of letters is a token of its own, so the word's ids serve with any of them.
END_MARKS = b".,;:!?"
#: Words encoded by one call.
AT_ONCE = 20_000
#: Bytes of text whose words are hashed at once, and of the longest word that is.
HASHED, LONGEST = 500_000, 200
#: What stands before a word: nothing, a space, or a line end.
BARE, SPACED, LINED = 0, 1, 2
#: ASCII white space beside the space and the line end, and the bytes that begin all other white space in UTF-8.
OTHER_SPACE = np.isin(np.arange(256), [9, 11, 12, 13, 28, 29, 30, 31])
WIDE_SPACE = re.compile("[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
LEADS_SPACE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
#: Letters that are one byte, and the lead and second bytes of the letters from U+00C0 to U+00FF.
LETTER = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
SECOND = np.array([128 <= c < 192 and c not in (0x97, 0xB7) for c in range(256)])


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's text: read on the driver and sent to tasks (its size is fixed, 1.6 MB)."""
    return Path(path or tokenizer_path()).read_text(encoding="utf-8")


def worker_encoder(json_text: str) -> WordEncoder:
    """The encoder of this Python worker process, kept between its tasks."""
    held = sys.modules.setdefault("tickloom_worker_encoders", types.ModuleType("tickloom_worker_encoders"))
    key = str(hash(json_text))
    if key not in held.__dict__:
        held.__dict__[key] = WordEncoder(json_text)
    return held.__dict__[key]


class Words:
    """The words of texts: where each begins and ends, what stands before it, which text it is of, and which texts are
    plain: words of at most LONGEST bytes, with a single space or line end between two of them and no other white space."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts)
        self.data = data = np.frombuffer(self.raw, np.uint8)
        cut = np.flatnonzero((data == 32) | (data == 10))
        starts, ends = np.concatenate([[0], cut + 1]), np.append(cut, len(data))
        firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        first_words = np.searchsorted(starts, firsts)  # the end included
        before = np.concatenate([np.zeros(1, np.uint8), np.where(data[cut] == 32, SPACED, LINED).astype(np.uint8)])
        before[first_words[:-1]] = BARE
        text_of = np.repeat(np.arange(len(texts)), np.diff(first_words))
        self.plain = np.ones(len(texts), bool)
        size = ends - starts
        self.plain[text_of[(size == 0) | (size > LONGEST)]] = False
        odd = np.flatnonzero(OTHER_SPACE[data])
        self.plain[np.searchsorted(firsts, odd, side="right") - 1] = False
        for i in np.unique(np.searchsorted(firsts, np.flatnonzero(LEADS_SPACE[data]), side="right") - 1).tolist():
            if self.plain[i] and WIDE_SPACE.search(texts[i].decode()):
                self.plain[i] = False
        good = self.plain[text_of]
        self.starts, self.ends, self.before = starts[good], ends[good], before[good]
        # Words of the plain texts, one text after the other; the end included.
        self.first_words = np.concatenate([[0], np.cumsum(np.diff(first_words)[self.plain])])
        self.marks = self._cut_marks()

    def _cut_marks(self) -> np.ndarray:
        """Takes the end mark off words of letters; the marks, 0 where there is none."""
        data, last = self.data, self.data[self.ends - 1]
        letter = LETTER[data].copy()
        pairs = np.flatnonzero(data[:-1] == 0xC3)
        pairs = pairs[SECOND[data[pairs + 1]]]
        letter[pairs] = letter[pairs + 1] = True
        others = np.concatenate([[0], np.cumsum(~letter)])
        marked = (self.ends - self.starts > 1) & np.isin(last, list(END_MARKS)) & (others[self.ends - 1] == others[self.starts])
        self.ends = self.ends - marked
        return np.where(marked, last, 0)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each word and what stands before it, and its first eight bytes with its length."""
        code = odd_numbers(256, 0)
        hashes, heads = np.empty(len(self.starts), np.uint64), np.empty(len(self.starts), np.uint64)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        most = HASHED + LONGEST + 2
        up, down = powers(BASE, most), powers(INVERSE, most)
        a = 0
        while a < len(self.starts):
            low = self.starts[a]
            b = max(a + 1, int(np.searchsorted(self.ends, low + HASHED, side="right")))
            starts, ends = self.starts[a:b] - low, self.ends[a:b] - low
            n = int(ends[-1])
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(code[self.data[low : low + n]] * up[:n], out=sums[1:])
            size = ends - starts
            raw = (sums[ends] - sums[starts]) * down[starts]
            hashes[a:b] = mixed(raw + size.astype(np.uint64) * np.uint64(3) + self.before[a:b])
            head = padded[self.starts[a:b, None] + np.arange(8)].view("<u8")[:, 0] & masks[np.minimum(size, 8)]
            heads[a:b] = head ^ (size.astype(np.uint64) << np.uint64(56))
            a = b
        return hashes, heads


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, the same as of ``Tokenizer.encode`` on the whole text.

    Strings of special tokens in a text are ordinary text. A null text is empty.
    """

    def __init__(self, json_text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json_text)
        self.tokenizer.encode_special_tokens = True
        (self.line_end,) = self.ids("\n")
        self.mark_ids = np.zeros(256, np.uint32)
        for m in END_MARKS:
            (self.mark_ids[m],) = self.ids(chr(m))
        # Known words: their hashes, rising; at the place of a word's hash also its head, and where its ids lie in ``pool``.
        # The first entry is no word, as no word has its head.
        self.place, self.heads = np.zeros(1, np.uint64), np.full(1, 2**64 - 1, np.uint64)
        self.at, self.size = np.zeros(1, np.int32), np.zeros(1, np.int32)
        self.pool = np.empty(0, np.uint32)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def learn(self, words: Words, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool with the ids of the words at ``new`` put behind the known ones, where each begins there and its number of ids.

        Many words are encoded at once, a line each, and their ids stay as they come."""
        raw, pool, pooled = words.raw, [self.pool], len(self.pool)
        spaced = words.before[new] == SPACED
        at, size = np.empty(len(new), np.int32), np.empty(len(new), np.int32)
        for lead, group in ((b" ", np.flatnonzero(spaced)), (b"", np.flatnonzero(~spaced))):
            for i in range(0, len(group), AT_ONCE):
                some = group[i : i + AT_ONCE]
                places = zip(words.starts[new[some]].tolist(), words.ends[new[some]].tolist(), strict=True)
                text = b"\n" + lead + (b"\n" + lead).join([raw[a:b] for a, b in places])
                ids = self.ids(text.decode())
                ends = np.append(np.flatnonzero(ids == self.line_end), len(ids))
                if len(ends) != len(some) + 1 or ends[0] != 0:
                    raise ValueError("the tokenizer joins words over line ends")
                at[some], size[some] = pooled + ends[:-1] + 1, np.diff(ends) - 1
                pool.append(ids)
                pooled += len(ids)
        # A line end stands in front of each word's ids, so a word after one takes it with it.
        lined = words.before[new] == LINED
        return np.concatenate(pool), at - lined, size + lined

    def remember(self, pool: np.ndarray, hashes: np.ndarray, heads: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        """Keep what a slice brought, unless that makes more than REMEMBERED words."""
        if len(self.place) + len(hashes) > REMEMBERED:
            return
        order = np.argsort(hashes)
        before = np.searchsorted(self.place, hashes[order], side="right")
        self.place, self.heads = (np.insert(x, before, y[order]) for x, y in ((self.place, hashes), (self.heads, heads)))
        self.at, self.size = (np.insert(x, before, y[order]) for x, y in ((self.at, at), (self.size, size)))
        self.pool = pool

    def of_words(self, words: Words) -> list[bytes] | None:
        """Ids of the plain texts; None if two of their words share a hash."""
        hashes, heads = words.keys()
        codes, distinct = pd.factorize(hashes)
        # Codes rise with the first word of each kind.
        top = np.maximum.accumulate(codes)
        first = np.flatnonzero(np.concatenate([[True], top[1:] > top[:-1]]))
        if (heads != heads[first][codes]).any():
            return None
        row = np.searchsorted(self.place, distinct, side="right") - 1
        known = self.place[row] == distinct
        if (self.heads[row] != heads[first])[known].any():
            return None
        at, size, pool = self.at[row], self.size[row], self.pool
        if not known.all():
            new = first[~known]
            pool, at[~known], size[~known] = self.learn(words, new)
            self.remember(pool, distinct[~known], heads[new], at[~known], size[~known])
        del hashes, heads, row
        out, marked = [], words.marks > 0
        sizes = size[codes] + marked
        ends = np.concatenate([[0], np.cumsum(sizes)])
        texts = len(words.first_words) - 1
        step = max(1, texts * HASHED // max(len(words.data), 1))  # the ids of some texts at a time
        for a in range(0, texts, step):
            bounds = words.first_words[a : a + step + 1]
            x, y = int(bounds[0]), int(bounds[-1])
            n, stops = sizes[x:y], ends[x + 1 : y + 1] - ends[x]
            ids = np.empty(int(stops[-1]), np.uint32)
            source = np.repeat(at[codes[x:y]] - (stops - n), n) + np.arange(len(ids))
            # Where a mark ends a word, the pool's next id stands in its place for the moment.
            np.take(pool, source, out=ids, mode="clip")
            here = marked[x:y]
            ids[stops[here] - 1] = self.mark_ids[words.marks[x:y][here]]
            raw, cuts = ids.tobytes(), ((ends[bounds] - ends[x]) * 4).tolist()
            out += [raw[p:q] for p, q in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def encode(self, texts: list[str | None], end: int | None = None) -> list[bytes]:
        last = b"" if end is None else np.uint32(end).astype("<u4").tobytes()
        out = [b""] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        if some:
            words = Words([texts[i].encode() for i in some])
            found = iter((self.of_words(words) if words.plain.any() else None) or ())
            for i, plain in zip(some, words.plain.tolist(), strict=True):
                ids = next(found, None) if plain else None
                out[i] = self.ids(texts[i]).tobytes() if ids is None else ids
        return [x + last for x in out]
