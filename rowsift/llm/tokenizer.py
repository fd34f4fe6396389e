"""Public tokenizers inside tasks: loaded once per worker and stage, with bounded caches.

Kinds by file name: ``.json`` (library tokenizers) and ``.model``
(sentencepiece). Where a tokenizer drops white space and never merges across
it, the ids of a text are the ids of its white-space separated words in a row,
so words can be looked up; any other tokenizer gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

import numpy as np

from .common import stage_kept

WORD_CACHE = 80_000
# Fixed value: the pre-token pattern for which plain words can skip the normaliser.
PLAIN_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# Letters whose lower case and composed form are the letter itself or one fixed
# letter, then punctuation: two pre-tokens at most, for any such word.
PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?$%&*#|]*)$")


def splits_at_space(path: str) -> bool:
    """True if the ids of a text are those of its words one after the other.

    Recognised form: a pre-tokenizer that removes white space between pieces,
    only context-free normalisers, added tokens that take no white space, and
    no post-processor, truncation or padding."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    norm = spec.get("normalizer") or {}
    norms = norm.get("normalizers", [norm] if norm else [])
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    drops = (first.get("type") == "Split" and first.get("behavior") == "Removed"
             and first.get("invert") is True and r"[^\s" in first["pattern"].get("Regex", "")
             and " " not in first["pattern"].get("Regex", " "))
    added = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word"))
                and not any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", []))
    rest = (pre.get("pretokenizers") or [pre])[1:]
    return bool(drops and added and not spec.get("truncation") and not spec.get("padding")
                and all(x.get("type") in ("NFC", "Lowercase", "Replace") for x in norms)
                and all(x.get("type") == "ByteLevel" and not x.get("add_prefix_space") for x in rest))


class Encoder:
    """``ids(texts)`` as the library gives them, without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.by_word = splits_at_space(path)
        self._mark = self._model = None
        if path.endswith(".json"):
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            batch = getattr(tok, "encode_batch_fast", tok.encode_batch)
            self._ids = lambda texts: [e.ids for e in batch(texts, add_special_tokens=False)]
            with open(path, encoding="utf-8") as f:
                added = json.load(f).get("added_tokens", [])
            self._special = [t["content"] for t in added]
            marks = [t for t in added if t.get("special") and not t.get("normalized")]
            if self.by_word and marks:
                self._mark = (marks[0]["content"], marks[0]["id"])
            if self.by_word and self._is_plain(path):
                from tokenizers.pre_tokenizers import ByteLevel
                level = ByteLevel(add_prefix_space=False, use_regex=False)
                letters = [chr(c) for c in range(0xC0, 0x100)]
                self._bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
                self._model = tok.model
        elif path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._ids = lambda texts: model.encode(texts, num_threads=1)
        else:
            raise ValueError(f"unknown kind of tokenizer: {path}")
        self._young: dict[int, bytes] = {}
        self._old: dict[int, bytes] = {}

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self._ids(texts) if texts else []

    @staticmethod
    def _is_plain(path: str) -> bool:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, norm = spec["pre_tokenizer"], spec.get("normalizer") or {}
        return (spec["model"].get("type") == "BPE"
                and [x["type"] for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
                and [x["type"] for x in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]
                and pre["pretokenizers"][0]["pattern"].get("Regex") == PLAIN_SPLIT)

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.translate(self._bytes)
        return array("I", [t.id for t in self._model.tokenize(piece)]).tobytes()

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of single words; plain ones go straight to the merges."""
        if self._model is None:
            return self._encode_any(words)
        out, others, marks = [], [], {"": b""}
        for w in words:
            m = PLAIN_WORD.match(w)
            if m is None:
                others.append(w)
                out.append(None)
                continue
            end = marks.get(m[2])
            if end is None:
                end = marks[m[2]] = self._piece(m[2])
            out.append(self._piece(m[1].lower()) + end)
        if others:
            rest = iter(self._encode_any(others))
            out = [next(rest) if x is None else x for x in out]
        return out

    def _encode_any(self, words: list[str]) -> list[bytes]:
        """Ids of single words. Words are encoded as one text with a special
        token between them (it is cut out before anything else happens to the
        text, so it separates exactly); words that hold one go alone."""
        if self._mark is None or any(s in w for s in self._special for w in words):
            return [np.asarray(x, np.uint32).tobytes() for x in self._ids(words)]
        text, mark = self._mark
        ids = np.asarray(self._ids([text.join(words)])[0], np.uint32)
        cuts = np.flatnonzero(ids == mark)
        raw = ids.tobytes()
        starts = [0, *((cuts + 1) * 4).tolist()]
        return [raw[a:b] for a, b in zip(starts, [*(cuts * 4).tolist(), len(raw)])]

    def hashed_words(self, keys: np.ndarray, word_at: Callable[[int], str]) -> list[bytes]:
        """Ids of words as uint32 bytes by their hashes; ``word_at(i)`` gives the i-th
        word's text. Two bounded generations of a cache: words in use move to the young one,
        the old one is dropped whenever the young one is full."""
        young, old, out, new = self._young, self._old, [], []
        for i, k in enumerate(keys.tolist()):
            x = young.get(k)
            if x is None:
                x = old.get(k)
                if x is None:
                    new.append(i)
                else:
                    young[k] = x
            out.append(x)
        for a in range(0, len(new), 10_000):
            part = new[a:a + 10_000]
            for i, x in zip(part, self._encode([word_at(i) for i in part])):
                out[i] = young[int(keys[i])] = x
        if len(young) > WORD_CACHE:
            self._old, self._young = young, {}
        return out

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of single words as uint32 bytes."""
        out = []
        for a in range(0, len(words), 10_000):
            out += self._encode(words[a:a + 10_000])
        return out


def encoder(path: str) -> Encoder:
    return stage_kept(f"encoder {path}", lambda: Encoder(path))


class WordTable:
    """Frequent words with their ids: a compact hash table of plain arrays.

    Hashes in order, an index by their leading bits, number of ids, all ids in a row."""

    def __init__(self, hashes: np.ndarray, ids: list[bytes]):
        order = np.argsort(hashes)
        self.hashes = np.append(hashes[order], np.uint64(0xFFFFFFFFFFFFFFFF))
        self.sizes = np.array([len(ids[i]) // 4 for i in order.tolist()], np.uint16)
        self.ids = np.frombuffer(b"".join(ids[i] for i in order.tolist()), np.uint32)
        self.bits = max(1, int(len(hashes)).bit_length())
        slots = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.first = np.searchsorted(self.hashes[:-1], slots).astype(np.int32)

    def __len__(self) -> int:
        return len(self.sizes)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of every hash in the table, -1 where absent."""
        at = self.first[(h >> np.uint64(64 - self.bits)).astype(np.int64)].astype(np.int64)
        left = np.flatnonzero(self.hashes[at] < h)
        while len(left):
            at[left] += 1
            left = left[self.hashes[at[left]] < h[left]]
        return np.where((self.hashes[at] == h) & (at < len(self)), at, -1)
