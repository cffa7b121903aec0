"""Token ids of texts for tokenizer files that drop white space and mark word ends, many words at a time.

Such a file encodes the words between white space independently, so a worker keeps the ids of words it has met. New words are taken together: their letters, digits and
other marks are told apart by a table, the symbols of all pieces lie in one array, and every round merges the pair of lowest rank in each piece. Words with
characters about which Unicode tables differ, apostrophes (contractions), very long words and those that may hold a special token are given to the tokenizers library, as are
whole texts where the file is of another kind; all ids equal the library's.
"""

from __future__ import annotations

import gc
import json
import unicodedata

import numpy as np
import regex

from docsync.llm.bpe import byte_letters

#: Words whose ids are kept (about), new words looked at together, and bytes of the longest word that is not given to the library.
MAX_WORDS, TOGETHER, LONGEST = 500_000, 2_000, 64
# The pattern, the normalizers and the word end of files whose words can be encoded one by one.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORD_END = "</w>"
#: Characters about which all Unicode tables agree: printable ASCII but the apostrophe, Latin, Greek and Cyrillic, but for two capitals whose small letters
#: depend on more.
_PLAIN = regex.compile(r"[!-&(-~\u00a1-\u012f\u0131-\u03a2\u03a4-\u052f]+")
_ODD = regex.compile(r"[^\n!-&(-~\u00a1-\u012f\u0131-\u03a2\u03a4-\u052f]")
_NO_RANK = 1 << 30


def by_word(file: dict) -> bool:
    """Whether a tokenizer file encodes the words between white space independently of each other."""
    parts, splits, model = (file.get("normalizer") or {}).get("normalizers", []), (file.get("pre_tokenizer") or {}).get("pretokenizers", []), file["model"]
    return (
        [p["type"] for p in parts] == NORMALIZERS
        and (parts[1]["pattern"], parts[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and [p["type"] for p in splits] == ["Split", "ByteLevel"]
        and (splits[0]["pattern"], splits[0]["behavior"], splits[0]["invert"]) == ({"Regex": PATTERN}, "Removed", True)
        and not splits[1]["use_regex"] and not splits[1]["add_prefix_space"]
        and file.get("post_processor") is None
        and (model["type"], model.get("end_of_word_suffix"), model.get("dropout"), model.get("ignore_merges", False)) == ("BPE", WORD_END, None, False)
        and all(c + end in model["vocab"] for c in byte_letters().values() for end in ("", WORD_END))
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in file.get("added_tokens", []))
    )


class Merges:
    """The merges of a file as sorted pairs with their ranks."""

    def __init__(self, model: dict):
        ids, letters = model["vocab"], byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), np.array([ids[a + b] for a, b in pairs], np.int64)
        self.inner = np.array([ids[letters[b]] for b in range(256)], np.int64)
        self.ending = np.array([ids[letters[b] + WORD_END] for b in range(256)], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NO_RANK)

    def merge(self, symbol: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The final symbols of all pieces and the piece of each, in order. ``piece`` is the number of each symbol's piece, in ascending order."""
        rank = np.full(len(symbol), _NO_RANK, np.int64)
        inside = np.flatnonzero(piece[1:] == piece[:-1])
        rank[inside] = self.rank(symbol[inside], symbol[inside + 1])
        done = []
        while len(symbol):
            starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            best, sizes = np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbol)))
            if (best == _NO_RANK).any():
                going = np.repeat(best < _NO_RANK, sizes)
                done.append((symbol[~going], piece[~going]))
                symbol, piece, rank = symbol[going], piece[going], rank[going]
                sizes, best = sizes[best < _NO_RANK], best[best < _NO_RANK]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            hit = hit[np.append(True, piece[hit[1:]] != piece[hit[:-1]])]  # the leftmost of each piece
            symbol[hit] = self.made[best]
            kept = np.ones(len(symbol), bool)
            kept[hit + 1] = False
            symbol, piece, rank = symbol[kept], piece[kept], rank[kept]
            at = hit - np.arange(len(hit))
            for left in (at, at[at > 0] - 1):
                left = left[left + 1 < len(symbol)]
                rank[left] = np.where(piece[left] == piece[left + 1], self.rank(symbol[left], symbol[left + 1]), _NO_RANK)
            if at[-1] == len(symbol) - 1:
                rank[-1] = _NO_RANK
        if not done:
            return symbol, piece
        symbol, piece = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(piece, kind="stable")
        return symbol[order], piece[order]


class TokenIds:
    """Token ids of texts (bytes in UTF-8) as little-endian unsigned 32-bit numbers, by the contents of a tokenizer file."""

    def __init__(self, contents: str):
        from tokenizers import Tokenizer

        file = json.loads(contents)
        self.tokenizer = Tokenizer.from_str(contents)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.by_word = by_word(file)
        special = [t["content"] for t in file.get("added_tokens", [])]
        self.special = regex.compile("|".join(regex.escape(s[:2]) for s in special), regex.IGNORECASE) if special else None
        if self.by_word:
            self.merges = Merges(file["model"])
            letter, digit = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
            #: 0 line end, 1 letter, 2 digit, 3 other mark.
            self.kinds = np.array([0 if c == 10 else 1 if letter.match(chr(c)) else 2 if digit.match(chr(c)) else 3 for c in range(0x530)], np.uint8)

    @classmethod
    def load(cls, path: str) -> TokenIds:
        with open(path, encoding="utf-8") as f:
            return cls(f.read())

    def whole(self, texts: list[str]) -> list[bytes]:
        """By the library itself."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def is_special(self, text: str) -> bool:
        """Whether a special token may begin in a text, in capitals too."""
        return self.special is not None and self.special.search(text) is not None

    def is_plain(self, word: str) -> bool:
        return len(word) <= LONGEST and _PLAIN.fullmatch(word) is not None and unicodedata.is_normalized("NFC", word) and not self.is_special(word)

    def plain(self, lines: str) -> list[bytes]:
        """Of plain words, one on each line."""
        lines = lines.lower() + "\n"
        data = np.frombuffer(lines.encode(), np.uint8)
        first = (data & 0xC0) != 0x80
        kinds = self.kinds[np.frombuffer(lines.encode("utf-32-le"), np.uint32)]
        starts = np.append(True, kinds[1:] != kinds[:-1]) | (kinds == 2)
        byte_kind = kinds[np.cumsum(first) - 1]
        begins = np.zeros(len(data) + 1, bool)
        begins[:-1][first] = starts
        begins[-1] = True
        symbol = np.where(begins[1:], self.merges.ending[data], self.merges.inner[data])
        piece, word = np.cumsum(begins[:-1]), np.cumsum(byte_kind == 0)
        inside = byte_kind != 0
        word_of_piece = np.zeros(piece[-1] + 1, np.int64)
        word_of_piece[piece[inside]] = word[inside]
        final, at = self.merges.merge(symbol[inside], piece[inside])
        edges = (4 * np.searchsorted(word_of_piece[at], np.arange(word[-1] + 1))).tolist()
        ids = final.astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def learn(self, words: list[bytes]) -> None:
        """Encode words not known yet."""
        for i in range(0, len(words), TOGETHER):
            part = words[i : i + TOGETHER]
            texts = b"\n".join(part).decode()
            if max(map(len, part)) > LONGEST or _ODD.search(texts) or not unicodedata.is_normalized("NFC", texts) or self.is_special(texts):
                sure = [w for w in part if self.is_plain(w.decode())]
                rest = list(set(part) - set(sure))
                self.known.update(zip(rest, self.whole([w.decode() for w in rest]), strict=True))
                part, texts = sure, b"\n".join(sure).decode()
            if part:
                self.known.update(zip(part, self.plain(texts), strict=True))

    def of(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        collects = gc.isenabled()
        gc.disable()  # the lists made here hold no cycles, and looking for some takes a fifth of the time
        try:
            return self._of(texts)
        finally:
            if collects:
                gc.enable()

    def _of(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self.whole([t.decode() for t in texts])
        if len(self.known) > MAX_WORDS // 2:  # words that come back before the next such turn are kept, the others forgotten
            self.old, self.known = self.known, {}
        split = [t.split() if self.is_special(t.decode("latin-1")) else t.lower().split() for t in texts]
        known, old = self.known, self.old
        new = [w for w in set().union(*split) if w not in known]
        known.update([(w, old[w]) for w in new if w in old])
        self.learn([w for w in new if w not in known])
        return [b"".join([known[w] for w in words]) for words in split]


#: The tokenizers of this worker process, by the contents of their files.
_KNOWN: dict[str, TokenIds] = {}


def known_ids(contents: str) -> TokenIds:
    """The worker's tokenizer for a file, with the words it has met in earlier tasks."""
    if contents not in _KNOWN:
        _KNOWN[contents] = TokenIds(contents)
    return _KNOWN[contents]
