"""Token ids of whole texts by the tokenizers library, for a byte-level BPE with the usual pattern.

That pattern looks back at nothing and ahead at white space only, so a text may be cut at the end of any
of its matches and the parts encoded apart. numpy cuts whole blocks of texts

* before white space that follows other text; of a run of white space all but its last character is a
  part, and so is that one unless it is a blank, which belongs to the next part;
* between an ASCII letter or digit and an ASCII mark behind it.

Each worker keeps the ids of parts that it has met (up to 16 bytes long, in a table of fixed size, told
apart by all their bytes) and hands only new ones to the library, many at once: as they are cut where the
library cuts, their ids follow from the lengths of the tokens. A text with white space beyond ASCII or
with the string of a special token, and every text if the tokenizer is of another kind, goes to the
library whole. A text of any length is handled in slices.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from . import shingles as S

END_ID = 0
#: Slots of a worker's table of parts, and ids that it holds before it begins anew.
SLOTS, POOL = 1 << 20, 1 << 24
#: Bytes that are cut and looked up together.
SLICE = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORD = np.zeros(256, dtype=bool)  # ASCII letters and digits
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_MARK = ~(_SPACE | _WORD)
_MARK[128:] = False
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _cuttable(path: str) -> bool:
    """Whether the file describes a tokenizer that parts may be encoded apart with."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before = spec.get("pre_tokenizer") or {}
    return spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")


def _wide_space(raw: np.ndarray) -> np.ndarray:
    """Where a white space character beyond ASCII (or a separator 0x1C to 0x1F) ends."""
    odd = (raw >= 0x1C) & (raw <= 0x1F)
    if raw.max(initial=0) < 128:
        return np.flatnonzero(odd)
    a, b, c = raw[:-2], raw[1:-1], raw[2:]
    two = (raw[:-1] == 0xC2) & ((raw[1:] == 0x85) | (raw[1:] == 0xA0))
    three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    odd[1:] |= two
    odd[2:] |= three
    return np.flatnonzero(odd)


def cuts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sorted starts of the parts of the texts raw[at[i]:at[i+1]]; each text that isn't empty begins one."""
    n = len(raw)
    space, word = _SPACE[raw], _WORD[raw]
    begin = np.zeros(n + 1, dtype=bool)
    last, following = space[:-1], space[1:]
    begin[1:n] = following & ~last  # a run of white space begins
    begin[1:n] |= word[:-1] & _MARK[raw[1:]]
    ends = np.flatnonzero(last & ~following)  # the last character of each run
    begin[ends] = True
    begin[ends + 1] |= raw[ends] != 32
    begin[at] = True
    # A run at the very end of a text is one part: take back the start before its last character.
    first = np.zeros(n + 1, dtype=bool)
    first[at] = True
    edge = at[(at > 1) & (at < n)]
    edge = edge[space[edge - 1] & space[edge - 2] & ~space[edge] & ~first[edge - 1]]
    begin[edge - 1] = False
    begin[n] = False
    return np.flatnonzero(begin)


class Encoder:
    """Ids of texts, each followed by END_ID."""

    def __init__(self, path: str, literal_specials: bool = False) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = literal_specials
        added = self.library.get_added_tokens_decoder().values()
        self.specials = [] if literal_specials and all(t.special for t in added) else [t.content.encode() for t in added]
        self.cuttable = _cuttable(path)
        if self.cuttable:
            vocabulary = self.library.get_vocab()
            self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
            for token, i in vocabulary.items():
                self.token_bytes[i] = len(token)  # a character of the token stands for one byte
            self.line_end = self.library.encode("\n", add_special_tokens=False).ids
            self.cuttable = len(self.line_end) == 1
        self._restart()

    def _restart(self) -> None:
        self.head, self.tail = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.size = np.zeros(SLOTS, np.int32)  # bytes of the part; 0: an empty slot
        self.begin, self.count = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _append(self, ids: np.ndarray) -> int:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, np.uint32)

    def _encode_parts(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts raw[start:end], one part after another, and the count of each.

        Joined, they are cut again where each begins: behind a line end where no blank stands in front.
        """
        blank = (end - start > 1) & (raw[start] == 32) & ~_SPACE[raw[np.minimum(start + 1, len(raw) - 1)]]
        bare = ~_SPACE[raw[start]]
        data, counts = raw.tobytes(), np.zeros(len(start), np.int64)
        joined = b"".join([(b"\n" if b else b"") + data[s:e] for s, e, b, f in zip(start.tolist(), end.tolist(), bare.tolist(), blank.tolist(), strict=True) if b or f])
        got = [x.ids for x in self.library.encode_batch_fast([joined.decode()], add_special_tokens=False)][0]
        ids = np.array(got, np.uint32)
        easy = bare | blank
        stop = np.cumsum((end - start + bare)[easy])
        reach = np.cumsum(self.token_bytes[ids])
        place = np.searchsorted(reach, stop) + 1  # tokens up to the end of each part
        if len(stop) and (place[-1] > len(ids) or (reach[place - 1] != stop).any()):
            raise ValueError("the tokenizer doesn't cut where its pattern says")
        counts[easy] = np.diff(place, prepend=0) - bare[easy]
        keep = np.ones(len(ids), dtype=bool)
        keep[np.concatenate(([0], place[:-1]))[bare[easy]]] = False
        ids = ids[keep]
        if easy.all():
            return ids, counts
        each = dict(zip(np.flatnonzero(easy).tolist(), np.split(ids, np.cumsum(counts[easy])[:-1]), strict=True)) if easy.any() else {}
        for i in np.flatnonzero(~easy).tolist():  # white space only
            each[i] = self.whole(data[start[i] : end[i]])
            counts[i] = len(each[i])
        return np.concatenate([each[i] for i in range(len(start))]), counts

    def _slice(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without anything odd in them, one text after another, and the count of each."""
        start = cuts(raw, at)
        end = np.append(start[1:], len(raw))
        size = end - start
        window = np.lib.stride_tricks.as_strided(np.concatenate((raw, np.zeros(8, np.uint8))).view(), (len(raw) + 1, 8), (1, 1))
        eight = np.ascontiguousarray(window[start]).view("<u8").ravel()
        head = eight & _MASKS[np.minimum(size, 8)]
        tail = np.zeros(len(start), np.uint64)
        more = np.flatnonzero(size > 8)
        tail[more] = np.ascontiguousarray(window[end[more] - 8]).view("<u8").ravel()
        slot = ((S.mix(head ^ S.mix(tail + size.astype(np.uint64))) >> np.uint64(7)) & np.uint64(SLOTS - 1)).astype(np.int64)
        hit = (self.head[slot] == head) & (self.tail[slot] == tail) & (self.size[slot] == size)
        begin, count = self.begin[slot].astype(np.int64), self.count[slot].astype(np.int64)
        miss = np.flatnonzero(~hit | (size > 16))
        if len(miss):
            long = size[miss] > 16
            short = miss[~long]
            key = np.empty(len(short), dtype=[("h", "<u8"), ("t", "<u8"), ("n", "<i8")])
            key["h"], key["t"], key["n"] = head[short], tail[short], size[short]
            _, first, inverse = np.unique(S.mix(head[short] + S.mix(tail[short] ^ S.mix(size[short].astype(np.uint64)))), return_index=True, return_inverse=True)
            same = key == key[first[inverse]]  # equal hashes of different parts: each goes on its own
            fresh = np.concatenate((short[first], short[~same], miss[long]))
            ids, counts = self._encode_parts(raw, start[fresh], end[fresh])
            to = self._append(ids) + np.cumsum(counts) - counts
            begin[fresh], count[fresh] = to, counts
            begin[short[same]], count[short[same]] = to[inverse[same]], counts[inverse[same]]
            new = short[first]
            where = slot[new]
            self.head[where], self.tail[where], self.size[where] = head[new], tail[new], size[new]
            self.begin[where], self.count[where] = begin[new], count[new]
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(begin - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        owner = np.searchsorted(at, start, side="right") - 1
        return ids, np.bincount(owner, weights=count, minlength=len(at) - 1).astype(np.int64)

    def _plain(self, raw: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of one text, slice by slice; a slice ends before a blank that follows other text."""
        a = 0
        while a < len(raw):
            b = min(a + SLICE, len(raw))
            while b < len(raw):
                look = raw[b - 1 : b + 4096]
                found = np.flatnonzero((look[1:] == 32) & ~_SPACE[look[:-1]])
                if len(found):
                    b += int(found[0])
                    break
                b += max(len(look) - 1, 1)
            b = min(b, len(raw))
            yield self._slice(raw[a:b], np.array([0, b - a]))[0]
            a = b
            self._forget()

    def _forget(self) -> None:
        if self.used > POOL:
            self._restart()

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Ranges i, j of texts with all their ids, one text after another, and the count of each.

        Every text's ids end with END_ID. A range is about SLICE bytes, or one longer text.
        """
        raw, at = S.text_bytes(texts)
        for i, j in S.blocks(at, SLICE):
            part, cut = raw[at[i] : at[j]], at[i : j + 1] - at[i]
            odd = self._odd(part, cut)
            if j - i == 1 and not len(odd):
                ids = np.concatenate([*self._plain(part), np.array([END_ID], np.uint32)])
                yield i, j, ids, np.array([len(ids)])
                continue
            rest = np.delete(np.arange(j - i), odd)
            if len(odd):
                size = np.diff(cut)[rest]
                ids, counts = self._slice(part[np.repeat(cut[rest] - (np.cumsum(size) - size), size) + np.arange(size.sum())], np.concatenate(([0], np.cumsum(size)))) if len(rest) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            else:
                ids, counts = self._slice(part, cut)
            counts_all = np.zeros(j - i, np.int64)
            counts_all[rest] = counts
            apart = {int(k): self.whole(part[cut[k] : cut[k + 1]].tobytes()) for k in odd}
            for k, own in apart.items():
                counts_all[k] = len(own)
            counts_all += 1
            ends = np.cumsum(counts_all)
            out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
            inner = np.ones(len(out), dtype=bool)
            inner[ends - 1] = False
            out[ends - 1] = END_ID
            for k, own in apart.items():
                out[ends[k] - counts_all[k] : ends[k] - 1] = own
                inner[ends[k] - counts_all[k] : ends[k] - 1] = False
            out[inner] = ids
            yield i, j, out, counts_all
            self._forget()

    def _odd(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Numbers of the texts that must go to the library whole."""
        if not self.cuttable:
            return np.arange(len(at) - 1)
        where = [_wide_space(raw)]
        data = raw.tobytes()
        for special in self.specials:
            p = data.find(special)
            while p >= 0:
                where.append(np.array([p]))
                p = data.find(special, p + 1)
        return np.unique(np.searchsorted(at, np.concatenate(where), side="right") - 1)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
