"""Token ids of texts by a vocabulary file of the tokenizers library, encoded once per distinct word of a task."""

from __future__ import annotations

import hashlib
import os
import string
from collections.abc import Callable

import numpy as np

from tidewatch.llm.common import Words, steps, worker_cache

#: Distinct words a task keeps; beyond that those that did not come again go (a memory bound, results do not depend on it).
KEPT_WORDS = 600_000
#: Words that go to the library in one text.
TOGETHER = 2048
#: Bytes from which on a word's key is a digest: sums of powers modulo 2**64 tell words apart by chance only while they are short.
LONG_WORD = 256


class WordEncoder:
    """Encodes whole texts exactly as the library would, for vocabularies whose pieces never span white space.

    Such a vocabulary cuts texts at white space, so a text's ids are its words' ids in a row. ASCII white space is where
    cuts are made here; other white space stays inside a word and is left to the library. Strings of
    special tokens inside a text become those tokens, as the library has it by default. Words are known by 64-bit keys, in
    arrays sorted by key, so a step of texts looks its words up, and puts its ids together, at once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        #: Ids that end a word, where the vocabulary marks word ends.
        vocabulary = self.model.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        #: Words are taken apart only where that cannot hide a special token.
        special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.plain = not any(t.isalpha() or not t.strip(string.punctuation) for t in special)
        self.signs: dict[str, bytes] = {"": b""}
        self._forget(np.zeros(0, dtype=np.int64), first=True)

    def _forget(self, keep: np.ndarray, first: bool = False) -> None:
        """Keep the table's words at these places only."""
        if first:
            self.keys, self.pool = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype="<u4")
            self.begin, self.count, self.again = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
            return
        self.keys, begin, self.count = self.keys[keep], self.begin[keep], self.count[keep]
        self.pool, self.begin = _runs(self.pool, begin, self.count), np.cumsum(self.count) - self.count
        self.again = np.zeros(len(keep), dtype=bool)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (null: none)."""
        raw = [(t or "").encode() for t in texts]
        out: list[bytes] = []
        for part in steps(raw):
            out += self._step(raw[part])
        return out

    def _step(self, raw: list[bytes]) -> list[bytes]:
        words = Words(raw, lower=False)
        if not len(words.hashes):
            return [b""] * len(raw)
        data, hashes = words.data.tobytes(), words.hashes
        for i in np.flatnonzero(words.ends - words.starts >= LONG_WORD):
            hashes[i] = int.from_bytes(hashlib.blake2b(data[words.starts[i] : words.ends[i]], digest_size=8).digest(), "little")
        keys, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        place, held = self._find(keys)
        self.again[place[held]] = True
        if not held.all():
            new = at[~held]
            ids = self._words([data[a:b].decode() for a, b in zip(words.starts[new].tolist(), words.ends[new].tolist(), strict=True)])
            if len(self.keys) + len(ids) > KEPT_WORDS:
                often = np.flatnonzero(self.again)
                self._forget(often if len(often) <= KEPT_WORDS // 2 else often[:0])
                gone = keys[~self._find(keys)[1]]
                new = np.setdiff1d(gone, keys[~held], assume_unique=True)
                if len(new):  # known until now
                    old = at[np.searchsorted(keys, new)]
                    self._add(new, self._words([data[a:b].decode() for a, b in zip(words.starts[old].tolist(), words.ends[old].tolist(), strict=True)]))
            self._add(keys[~held], ids)
            place, _ = self._find(keys)
        count = self.count[place][which]
        ids = _runs(self.pool, self.begin[place][which], count).tobytes()
        cut = (4 * np.concatenate(([0], np.cumsum(count)))[words.offsets]).tolist()
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys in the table, and whether they are there."""
        place = np.searchsorted(self.keys, keys)
        held = place < len(self.keys)
        held[held] = self.keys[place[held]] == keys[held]
        return place, held

    def _add(self, keys: np.ndarray, ids: list[bytes]) -> None:
        count = np.fromiter((len(x) // 4 for x in ids), dtype=np.int64, count=len(ids))
        begin = len(self.pool) + np.cumsum(count) - count
        every = np.concatenate((self.keys, keys))
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.begin, self.count = np.concatenate((self.begin, begin))[order], np.concatenate((self.count, count))[order]
        self.again = np.concatenate((self.again, np.zeros(len(ids), dtype=bool)))[order]
        self.pool = np.concatenate((self.pool, np.frombuffer(b"".join(ids), "<u4")))

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words by the library."""
        # Letters with signs behind are two pieces, "word" and ",": words that share either need one call of the library.
        parts = [_stem(w) for w in words] if self.plain else [(w, "") for w in words]
        known: dict[str, bytes] = {}
        stems = {stem for stem, _ in parts}
        letters = [w for w in stems if w.isalpha()]
        for at in range(0, len(letters), TOGETHER):
            self._together(letters[at : at + TOGETHER], known)
        self._one_by_one(list(stems.difference(letters)), known)
        signs = {sign for _, sign in parts}.difference(self.signs)
        if len(self.signs) + len(signs) > 10_000:
            self.signs = {"": b""}
            signs = {sign for _, sign in parts if sign}
        self._one_by_one(list(signs), self.signs)
        return [known[stem] + self.signs[sign] for stem, sign in parts]

    def _one_by_one(self, words: list[str], into: dict[str, bytes]) -> None:
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            for w, e in zip(part, self.model.encode_batch_fast(part, add_special_tokens=False), strict=True):
                into[w] = np.asarray(e.ids, dtype="<u4").tobytes()

    def _together(self, words: list[str], into: dict[str, bytes]) -> None:
        """Words of letters alone: each is one piece, so its ids go up to the next id that ends a word. Where the counts do
        not say so (a letter that the vocabulary's rules take apart), each word is encoded by itself."""
        ids = np.asarray(self.model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1 if len(ids) and int(ids.max()) < len(self.ends) else ()
        if len(ends) != len(words) or ends[-1] != len(ids):
            self._one_by_one(words, into)
            return
        raw, begin = ids.tobytes(), 0
        for w, end in zip(words, (4 * ends).tolist(), strict=True):
            into[w] = raw[begin:end]
            begin = end


def _runs(values: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs of values that begin there, one after another."""
    end = np.cumsum(count)
    return values[np.repeat(begin - end + count, count) + np.arange(end[-1] if len(end) else 0)]


def _stem(word: str) -> tuple[str, str]:
    """A word as (stem, signs): letters without the ASCII signs behind them, plain ASCII letters without capitals.

    A sign does not join a letter before it, and none at the end of a word begins a contraction. Other letters than Latin ones, and
    the one whose small form ends in a mark, may end in a mark that signs join; they stay together.
    """
    stem = word.rstrip(string.punctuation)
    if not stem.isalpha():
        return word, ""
    if stem.isascii():
        return stem.lower(), word[len(stem) :]
    return (stem, word[len(stem) :]) if stem[-1] <= "\u024f" and stem[-1] != "\u0130" else (word, "")


_MADE: dict[str, WordEncoder] = worker_cache()


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process; the vocabulary is loaded once."""
    if path not in _MADE:
        _MADE[path] = WordEncoder(path)
    return _MADE[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def id_limit(path: str, end_id: int | None) -> int:
    """One more than the largest id that can come."""
    known = encoder(path).model.get_vocab(with_added_tokens=True).values()
    return max([*known, end_id or 0]) + 1


def id_batches(path: str, end_id: int | None) -> Callable[[list[str | None]], list[bytes]]:
    """texts -> id payloads, each followed by the end id where one is given."""
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), 256):
            out += [ids + tail for ids in encoder(path).encode(texts[at : at + 256])]
        return out

    return run
