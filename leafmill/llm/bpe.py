"""BPE encoding with a pair occurrence index, and decoding.

All distinct words of a batch lie in one array of symbols.  The index maps each pair that has a rank
to all its positions there.  Ranks are applied in ascending order: every listed position that still
holds the pair is merged at once, and the pairs that this makes at its sides join their own lists.
A pair made by a merge comes later in a vocabulary in which each token has one merge; where it
doesn't, a word's occurrences are merged one at a time.

Texts are cut at ASCII white space, which no token crosses, and pieces are looked up in a table of
pieces already encoded.  The table is bounded: it only spares work, and what isn't in it is encoded.
Normalising and pre-tokenizing (not merging) of pieces beyond printable ASCII is the library's.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leafmill.llm.common import release, texts_of

ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9 ]+| ")
CACHE_PIECES = 300_000
CACHE_HITS = 4
REST_HITS = 8
BATCH_CHARS = 8 << 20
"""So many characters' new pieces are encoded at once; what they share is then done once."""
IDS_CHARS = 1 << 20
"""So many characters' ids are in memory at once."""
CUT_PIECES = 1 << 15
"""So many pieces are cut to words at once: those are many small objects."""
SPACE = re.compile(r"\s")
START_CHARS = 1 << 18
"""So many characters are looked up at once when the index is made."""


class PairIndex:
    """A vocabulary's merges by pair, and the merging of many words at once."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.size = max(vocab.values()) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left * self.size + right
        # a pair that is listed twice has its last rank, as in the library
        last = {int(k): i for i, k in enumerate(key)}
        order = np.array(sorted(last), np.int64)
        self.keys = np.append(order, np.int64(-1))
        self.ranks = np.append(np.array([last[int(k)] for k in order], np.int64), -1)
        self.left, self.right, self.made = left, right, made
        birth = np.full(self.size, -1, np.int64)
        np.maximum.at(birth, made, np.arange(len(made)))
        rank = np.arange(len(made))
        self.ordered = bool(((birth[left] < rank) & (birth[right] < rank)).all())
        self.plain = np.full(0x110000, -1, np.int32)
        self.final = np.full(0x110000, -1, np.int32)
        for token, i in vocab.items():
            if len(token) == 1:
                self.plain[ord(token)] = i
            if suffix and len(token) == len(suffix) + 1 and token.endswith(suffix):
                self.final[ord(token[0])] = i
        if not suffix:
            self.final = self.plain

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.keys[:-1], key)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], -1)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word ends.  Words have one character at least."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(length)
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        n = len(code)
        sym = np.empty(n + 1, np.int32)
        sym[:n] = self.plain[code]
        sym[ends - 1] = self.final[code[ends - 1]]
        sym[n] = -1  # stands beyond either end of a word
        word = None if self.ordered else np.repeat(np.arange(len(words), dtype=np.int32), length)
        nxt = np.arange(1, n + 2, dtype=np.int32)
        nxt[ends - 1] = n
        nxt[n] = n
        prv = np.arange(-1, n, dtype=np.int32)
        prv[(ends - length)] = n
        prv[n] = n

        index: dict[int, list[np.ndarray]] = {}

        def add(where: np.ndarray) -> None:
            rank = self.rank_of(sym[where], sym[nxt[where]])
            some = rank >= 0
            where, rank = where[some], rank[some]
            if not len(where):
                return
            order = np.argsort(rank, kind="stable")
            where, rank = where[order], rank[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            begin = [0, *cut.tolist()]
            for a, b in zip(begin, [*begin[1:], len(where)], strict=True):
                r = int(rank[a])
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(where[a:b])

        active: list[int] = []
        for begin in range(0, n, START_CHARS):
            add(np.arange(begin, min(begin + START_CHARS, n), dtype=np.int32))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            a, b = self.left[rank], self.right[rank]
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            if len(at) > 1:
                at = np.sort(at)
                at = at[np.append(True, at[1:] != at[:-1])]
            at = at[(sym[at] == a) & (sym[nxt[at]] == b)]
            if not len(at):
                continue
            if a == b and len(at) > 1:  # of overlapping pairs, the left one
                taken, free = [], -1
                for p in at.tolist():
                    if p != free:
                        taken.append(p)
                        free = nxt[p]
                at = np.array(taken)
            if not self.ordered:
                first = np.unique(word[at], return_index=True)[1]
                if len(first) < len(at):
                    index[rank] = [np.delete(at, first)]
                    heapq.heappush(active, rank)
                    at = at[first]
            gone = nxt[at]
            after = nxt[gone]
            sym[at] = self.made[rank]
            sym[gone] = -1
            nxt[at] = after
            prv[after] = at
            prv[n] = n
            before = prv[at]
            add(np.concatenate([at, before[before != n]]))
        held = sym[:n] >= 0
        return sym[:n][held], np.cumsum(np.add.reduceat(held, ends - length)) if n else ends


def ragged(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions of runs that begin at ``begin``, one run after the other."""
    before = np.cumsum(length) - length
    at = np.repeat(begin - before, length)
    at += np.arange(len(at))
    return at


def counter() -> defaultdict:
    """A dictionary that numbers its keys as they are first asked for."""
    return defaultdict(count().__next__)


class Table:
    """Keys, numbered as they are first asked for, and the ids of each."""

    def __init__(self):
        self.number = counter()
        self.keep(np.empty(0, np.int64))

    def keep(self, chosen: np.ndarray) -> None:
        """Keep the chosen keys only."""
        if len(chosen):
            keys = list(self.number)
            keys = [keys[i] for i in chosen.tolist()]
            self.flat = self.flat[ragged(self.begin[chosen], self.length[chosen])]
            self.length = self.length[chosen]
        else:
            keys, self.flat, self.length = [], np.empty(0, np.int32), np.empty(0, np.int64)
        self.number = counter()
        for k in keys:
            self.number[k]
        self.begin = np.cumsum(self.length) - self.length
        self.hits = np.zeros(len(keys), np.int32)

    def trim(self, most: int) -> None:
        """With over ``most`` keys, what has come up again and again stays."""
        if len(self.number) > most:
            self.keep(np.flatnonzero(self.hits >= CACHE_HITS))

    def put(self, flat: np.ndarray, length: np.ndarray) -> None:
        """The ids of all keys that were numbered since the last time."""
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.hits = np.concatenate([self.hits, np.zeros(len(length), np.int32)])

    def ids(self, which: np.ndarray) -> np.ndarray:
        """The ids of keys, by number, in a row; the keys count as used."""
        self.hits += np.bincount(which, minlength=len(self.hits)).astype(np.int32)
        return self.flat[ragged(self.begin[which], self.length[which])]


class Codec:
    """A tokenizer file: pieces to ids by the pair index, ids to text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.library = Tokenizer.from_file(path)
        bpe = model["model"]
        self.index = PairIndex(bpe["vocab"], bpe["merges"], bpe.get("end_of_word_suffix") or "")
        self.added = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.token = {i: t for t, i in (bpe["vocab"] | self.added).items()}
        self.shown = [self.token.get(i, "").encode() for i in range(max(self.token) + 1)]
        self.decimal = [b"%d" % i for i in range(max(self.token) + 1)]
        self.pieces = Table()

    def rest(self) -> None:
        """At the end of a task: only what is used most stays in the table."""
        self.pieces.keep(np.flatnonzero(self.pieces.hits >= REST_HITS))
        release()

    def words(self, piece: str) -> list[str | int]:
        """Byte-level words of one piece; an added token is its id."""
        out: list[str | int] = []
        at = 0
        for m in [*self.cut.finditer(piece), None]:
            part = piece[at : m.start() if m else None]
            if part:
                part = self.library.normalizer.normalize_str(part)
                out += [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(part) if w]
            if m:
                out.append(self.added[m[0]])
                at = m.end()
        return out

    def learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces and put them at the end of their table.  Most are cut to words at once."""
        rest = [k for k, p in enumerate(pieces) if b"<|" in p and self.cut.search(p.decode())]
        special = set(rest)
        plain, wide = [], []
        for k, p in enumerate(pieces):
            if k in special:
                continue
            if p.isascii():
                (plain if p.decode().isprintable() else rest).append(k)
            else:
                (rest if SPACE.search(p.decode()) else wide).append(k)
        words = Table()
        word = words.number
        owner, found = [], []

        for some in (plain[i : i + CUT_PIECES] for i in range(0, len(plain), CUT_PIECES)):
            text = b" ".join([pieces[k] for k in some]).decode().lower()
            w = np.fromiter(map(word.__getitem__, ASCII_WORDS.findall(text)), np.int64)
            gap = w == word[" "]
            own = np.array(some)[np.cumsum(gap)]
            owner.append(own[~gap])
            found.append(w[~gap])
        for some in (wide[i : i + CUT_PIECES] for i in range(0, len(wide), CUT_PIECES)):
            text = self.library.normalizer.normalize_str(b" ".join([pieces[k] for k in some]).decode())
            sizes = np.array([len(x) + 1 for x in text.split(" ")])
            if len(sizes) != len(some):  # the library sees white space where Python doesn't
                rest += some
            else:
                cut = self.library.pre_tokenizer.pre_tokenize_str(text)
                at = np.fromiter((x[1][0] for x in cut), np.int64, len(cut))
                owner.append(np.array(some)[np.searchsorted(np.cumsum(sizes), at, side="right")])
                found.append(np.fromiter((word[x[0]] for x in cut), np.int64, len(cut)))
        for k in rest:
            ws = self.words(pieces[k].decode())
            owner.append(np.full(len(ws), k, np.int64))
            found.append(np.array([word[w] for w in ws], np.int64))

        new = list(word)
        fixed = np.array([type(w) is int for w in new], bool)  # added tokens
        free = np.array([type(w) is str and w != " " for w in new], bool)  # the gap is never a word
        merged = [w for w, m in zip(new, free.tolist(), strict=True) if m]
        ids, ends = self.index.encode(merged) if merged else (np.empty(0, np.int64),) * 2
        size = fixed.astype(np.int64)
        size[free] = np.diff(ends, prepend=0)
        flat = np.empty(int(size.sum()), np.int64)
        flat[np.repeat(free, size)] = ids
        flat[np.repeat(fixed, size)] = [w for w in new if type(w) is int]
        words.put(flat, size)

        own = np.concatenate([*owner, np.empty(0, np.int64)])
        which = np.concatenate([*found, np.empty(0, np.int64)])
        order = np.argsort(own, kind="stable")
        own, which = own[order], which[order]
        size = np.bincount(own, words.length[which], minlength=len(pieces)).astype(np.int64)
        self.pieces.put(words.ids(which), size)

    def look_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' pieces by number, in a row, new ones encoded, and where each text begins and the last ends."""
        self.pieces.trim(CACHE_PIECES)
        number = self.pieces.number
        known = len(number)
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.string()))  # at the ends of a text a piece may be empty
        held = cut.flatten().dictionary_encode()
        distinct = held.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(number.__getitem__, distinct), np.int32, len(distinct))
        new = list(islice(number, known, None))
        if new:
            self.learn(new)
        return numbers[held.indices.to_numpy()], cut.offsets.to_numpy()

    def ids(self, k: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in a row, and where the ids of each text end, whose pieces end at ``ends``."""
        return self.pieces.ids(k), np.append(0, np.cumsum(self.pieces.length[k]))[ends]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text ends."""
        k, at = self.look_up(texts)
        return self.ids(k, at[1:])

    def encoded(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same of some texts at a time; until then they are numbers of pieces, far smaller than ids."""
        for some in slices(texts, BATCH_CHARS):
            here = texts[some]
            k, at = self.look_up(here)
            for part in slices(here, IDS_CHARS):
                a, b = at[part.start], at[part.stop]
                yield self.ids(k[a:b], at[part.start + 1 : part.stop + 1] - a)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per Python worker."""
    made = Codec(path)
    release()  # the parsed file is large
    return made


def slices(texts: list[str], chars: int) -> Iterator[slice]:
    """Runs of texts of about ``chars`` code points, a text at least."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield slice(begin, i + 1)
            begin, held = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def encode(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", full: bool = True
) -> DataFrame:
    """Per text: id, n_tokens, ids_sha256, decoded_sha256; with ``full`` also ids and decoded.

    ``tokenizer``: path of a tokenizers file, the same on all workers.  A null text is empty and has
    no tokens, as has one of white space.  Decoding joins tokens by a space, as the file, which names
    no decoder, prescribes.  Rows are independent: repeated rows, null ids and an empty table need
    no care, and other columns are ignored.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if full else [])]
    kinds = ["long", "string", "string", "array<int>", "string"]

    @F.pandas_udf(", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=False)))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(tokenizer)
        for batch in batches:
            texts, out = batch.tolist(), []
            for flat, ends in own.encoded(texts):
                for ids in np.split(flat, ends[:-1]):
                    ids = ids.tolist()
                    text = b" ".join(map(own.shown.__getitem__, ids))
                    row = (
                        len(ids),
                        hashlib.sha256(b" ".join(map(own.decimal.__getitem__, ids))).hexdigest(),
                        hashlib.sha256(text).hexdigest(),
                    )
                    out.append(row + ((ids, text.decode()) if full else ()))
            yield pd.DataFrame(out, columns=names)
        own.rest()

    rows = texts_of(docs, id_col, text_col)
    return rows.select("id", run("text").alias("r")).select("id", "r.*")


def decode(ids: Iterable[int], tokenizer: str) -> str:
    """The text of token ids."""
    own = codec(tokenizer)
    return " ".join(own.token[i] for i in ids)
