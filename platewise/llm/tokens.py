"""Token ids of whole texts, many times faster than one call per text, with the same ids.

The vocabulary file has word-end marks, so a text's ids are the ids of its white-space separated chunks, one
after the other. A batch's distinct chunks go through the vocabulary's own normaliser and word pattern and then, as
one long string, through a byte-pair encoder that reads the same merges. Chunks of ASCII and Latin-1 letters never
become strings of their own; others seen before come from a bounded table. Chunks with characters that this route
reserves go through the tokenizer itself.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Chunks of other characters that a worker remembers (about 200 bytes each).
REMEMBERED = 250_000
_MARK, _CUT = "\x01", "\x02"
_CUT_ID = 1_000_000
#: Chunks of printable ASCII and Latin-1 letters (and without "<|"): lower-casing is all that normalisation does to them.
_PLAIN = r"\A[!-~À-ÖØ-öø-ÿ]*\z"
#: The vocabulary's word pattern, restricted to those characters, and the cut between chunks.
_LATIN_WORDS = re.compile(_CUT + r"|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+").findall


def _byte_of() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file (the usual byte-level table, by its rule)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            table[chr(extra)] = b
            extra += 1
    return table


class FastTokenizer:
    """Built once per task from the vocabulary file; ``flat`` gives uint32 ids of whole batches."""

    def __init__(self, vocabulary: str = VOCABULARY, remembered: int = REMEMBERED):
        path = public_tokenizers.path(vocabulary)
        self.own = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix, byte_of = spec["model"]["end_of_word_suffix"], _byte_of()
        special = {t["content"] for t in spec["added_tokens"]}
        if not all(t.startswith("<|") for t in special):
            raise ValueError("special tokens of another form")
        ranks = {}
        for token, k in spec["model"]["vocab"].items():
            if token not in special:
                end = token.endswith(suffix)
                body = bytes(byte_of[c] for c in (token[:-len(suffix)] if end else token))
                ranks[body + _MARK.encode() * end] = k
        # A reserved byte's own entry would clash with the word-end mark: such texts take the other route.
        ranks[_MARK.encode()] = _CUT_ID + 1
        self.fast = tiktoken.Encoding("words", pat_str=rf"{_CUT}|[^{_MARK}{_CUT}]+{_MARK}",
                                      mergeable_ranks={**ranks, _CUT.encode(): _CUT_ID}, special_tokens={})
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(f"{_CUT}|(?:{pattern})")
        self.known: dict[str, bytes] = {}
        self.remembered = remembered

    def _exact(self, chunk: str) -> bytes:
        return np.array(self.own.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode(self, marked: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of marked words, with the cuts between chunks, and where each chunk's ids begin and end."""
        ids = self.fast.encode_to_numpy(marked, disallowed_special=())
        cuts = np.flatnonzero(ids == _CUT_ID)
        return ids, np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(ids)]])

    def _plain(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_encode``, of chunks of ``_PLAIN`` characters: one pass over all of them, without a string for each."""
        joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(chunks)], chunks), pa.scalar(_CUT, chunks.type))[0].as_py()
        words = _MARK.join(_LATIN_WORDS(joined.lower())) + _MARK
        return self._encode(words.replace(_CUT + _MARK, _CUT) if len(words) > 1 else "")

    def _learn(self, chunks: list[str]) -> None:
        rest = []
        for c in chunks:
            if _MARK in c or _CUT in c or "<|" in c:
                self.known[c] = self._exact(c)
            else:
                rest.append(c)
        if rest:
            text = self.own.normalizer.normalize_str(f" {_CUT} ".join(rest))
            ids, start, end = self._encode("".join([w if w == _CUT else w + _MARK for w in self.words.findall(text)]))
            data = ids.tobytes()
            self.known.update(zip(rest, [data[4 * a:4 * b] for a, b in zip(start.tolist(), end.tolist())]))

    def _others(self, chunks: list[str]) -> list[bytes]:
        if len(self.known) > self.remembered:
            self.known.clear()
        known = self.known
        new = [c for c in chunks if c not in known]
        if new:
            self._learn(new)
        return [known[c] for c in chunks]

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids that hold those of each chunk, where they begin, and how many they are."""
        plain = pc.and_not(pc.match_substring_regex(chunks, _PLAIN), pc.match_substring(chunks, "<|"))
        at = np.asarray(plain, dtype=bool)
        if at.all():
            ids, start, end = self._plain(chunks)
            return ids, start, end - start
        each = self._others(chunks.filter(pc.invert(plain)).to_pylist())
        start, size = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        size[~at] = np.fromiter(map(len, each), np.int64, len(each)) // 4
        start[~at] = np.cumsum(size[~at]) - size[~at]
        ids = np.frombuffer(b"".join(each), dtype="<u4")
        if at.any():
            more, begin, end = self._plain(chunks.filter(plain))
            start[at], size[at] = begin + len(ids), end - begin
            ids = np.concatenate([ids, more])
        return ids, start, size

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string array (null: empty), one text after the other, and where each text begins and ends."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        # Only characters that every white-space rule agrees on part chunks here.
        whole = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), "\n", " ")
        parts = pc.split_pattern(whole, " ")
        coded = parts.flatten().dictionary_encode()
        ids, start, size = self._chunks(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False)
        sizes = size[at]
        ends = np.cumsum(sizes)
        small = np.int32 if len(ids) < 1 << 31 and (not len(ends) or ends[-1] < 1 << 31) else np.int64
        where = np.repeat((start[at] - (ends - sizes)).astype(small), sizes)
        where += np.arange(len(where), dtype=small)
        first = np.concatenate([[0], ends])[np.asarray(parts.offsets, dtype=np.int64) - parts.offsets[0].as_py()]
        return ids[where], first

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens."""
        flat, at = self.flat(pa.array(texts, pa.large_string()))
        return np.split(flat, at[1:-1]) if len(texts) else []
