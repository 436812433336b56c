"""Token ids of whole texts by the tokenizers library, with a cache of words.

Both vocabularies split a text into pieces before they merge, and no piece
spans a letter a-z and the white space or mark after it. So a text's ids are
those of its words in a row, and words repeat. Texts are cut into words all at
once, by looking at bytes and their neighbours; the distinct words of a chunk
are encoded by the library itself, or come from a bounded cache; ids are then
put in the words' places by one gather. ``encode`` gives little-endian
unsigned 32-bit ids as bytes. Texts of any length are encoded whole.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa

#: Words that one worker's cache takes up before it lets those go that were
#: not met again since the last time (twice as many are held at most, 100 MB).
CACHE_WORDS = 300_000
#: Bytes of text that are cut into words at once, new words encoded at once.
CHUNK, NEW_WORDS = 4 << 20, 20_000

_SPACE, _LETTER, _MARK, _BLANK = 1, 2, 4, 8
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t\n\r\x0b\x0c")] = _SPACE
_KIND[0x20] |= _BLANK
_KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = _LETTER
# after a letter all of these begin a piece (an apostrophe may not)
_KIND[list(b"0123456789!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = _MARK
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]
# white space that is none for the bytes above
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
# a place where any text may be parted: between a letter and one blank
_SEAM = re.compile(rb"[A-Za-z] (?=[A-Za-z])")


class Encoder:
    """``file``: a vocabulary of the tokenizers library. ``spaces``: whether
    white space is part of the pieces (byte-level) or dropped (word ends)."""

    def __init__(self, file: str, spaces: bool, cache_words: int = CACHE_WORDS, chunk: int = CHUNK):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        # texts with the string of an added token are given to the library whole
        marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.first = sorted({c for m in marks for c in m[0].lower() + m[0].upper()})
        self.marks = re.compile("|".join(map(re.escape, marks)), re.IGNORECASE)
        self.spaces, self.chunk, self.model = spaces, chunk, self.tokenizer.model
        # how the byte-level step spells a blank
        from tokenizers.pre_tokenizers import ByteLevel
        self.blank = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(" ")[0][0]
        self.cache = _Words(self, cache_words)
        # parts words that are encoded together: a piece of its own, of one id
        self.fence, mark = (b"\n", b"\n") if spaces else (b" | ", b"|")
        self.fence_mark, self.fence_id = mark, np.frombuffer(self.plain(mark.decode()), "<u4")

    def plain(self, text: str) -> bytes:
        """Ids of a text, encoded by the library as it is."""
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, "<u4").tobytes()

    def special(self, text: str) -> bool:
        """Whether a text may hold the string of an added token."""
        return any(c in text for c in self.first) and self.marks.search(text) is not None

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words. Letters a-z (and a blank before them) are one piece,
        which the vocabulary's model merges straight away; other words are
        encoded by the whole tokenizer, in a row with fences between; white
        space, and words that hold a fence, one by one."""
        out: list[bytes | None] = [None] * len(words)
        rest, merge, blank = [], self.model.tokenize, self.blank
        for i, w in enumerate(words):
            if w.isalpha() or self.spaces and w[:1] == b" " and w[1:].isalpha():
                text = w.decode().replace(" ", blank) if self.spaces else w.decode().lower()
                ids = [t.id for t in merge(text)]
                out[i] = _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()
            elif len(self.fence_id) != 1 or _KIND[w[-1]] & _SPACE or self.fence_mark in w:
                out[i] = self.plain(w.decode())
            else:
                rest.append(i)
        for at in range(0, len(rest), NEW_WORDS):
            part = rest[at:at + NEW_WORDS]
            text = self.fence.join([words[i] for i in part]) + self.fence
            ids = np.frombuffer(self.plain(text.decode()), "<u4")
            ends = np.flatnonzero(ids == self.fence_id[0])
            data = ids.tobytes()
            for i, a, b in zip(part, [0, *(ends[:-1] + 1).tolist()], ends.tolist()):
                out[i] = data[4 * a:4 * b]
        return out

    def cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where words begin in texts that stand in a row from ``starts``."""
        kind = _KIND[data]
        before = np.empty_like(kind)
        before[0], before[1:] = 0, kind[:-1]
        before[starts] = 0
        space, spaced = kind & _SPACE != 0, before & _SPACE != 0
        cut = (kind & _MARK != 0) & (before & _LETTER != 0)
        if self.spaces:
            after = np.ones_like(space)  # at a text's end nothing is parted
            after[:-1] = space[1:]
            after[starts[1:] - 1] = True
            # a run of white space: all of it but the last character, which
            # goes to the word after it if it is a blank and stands alone if not
            cut |= space & (~spaced | ~after)
            cut |= ~space & spaced & (before & _BLANK == 0)
        else:
            cut |= space != spaced
        cut[starts] = True
        return np.flatnonzero(cut)

    def _row(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts, none of them empty, that are looked at together."""
        data = b"".join(texts)
        starts = np.cumsum([0, *map(len, texts[:-1])])
        cuts = self.cuts(np.frombuffer(data, np.uint8), starts)
        offsets = np.append(cuts, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        at = coded.indices.to_numpy()
        ids = self.cache.ids(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        first = np.cumsum(size, dtype=np.int32) - size
        n = size[at]
        ends = np.cumsum(n, dtype=np.int32)
        place = np.repeat(first[at] - (ends - n), n)
        place += np.arange(len(place), dtype=np.int32)
        flat = np.frombuffer(b"".join(ids), "<u4")[place]
        parts = np.append((ends - n)[np.searchsorted(cuts, starts)], ends[-1])
        return [flat[a:b].tobytes() for a, b in zip(parts[:-1], parts[1:])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        row: list[tuple[int, bytes]] = []
        held = 0

        def take():
            for (i, _), ids in zip(row, self._row([part for _, part in row]) if row else []):
                out[i].append(ids)
            row.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            if self.special(text) or self.spaces and _OTHER_SPACE.search(text):
                out[i].append(self.plain(text))
                continue
            data = text.encode("utf-8", "replace")
            data = data if self.spaces else data.lower()
            at = 0
            while at < len(data):  # a long text goes in parts
                seam = _SEAM.search(data, at + self.chunk) if len(data) - at > self.chunk else None
                end = seam.start() + 1 if seam else len(data)
                row.append((i, data[at:end]))
                held += end - at
                at = end
                if held >= self.chunk:
                    take()
                    held = 0
        take()
        return [b"".join(ids) for ids in out]


class _Words:
    """Ids by word, encoded when a word is first met, in two generations: when
    the young one is full it becomes the old one, and of that only the words
    that are met again come back."""

    def __init__(self, encoder: Encoder, limit: int):
        self.encoder, self.limit = encoder, limit
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        found = list(map(self.young.get, words))
        missing = [i for i, x in enumerate(found) if x is None]
        if len(self.young) + len(missing) > self.limit:
            self.old, self.young = self.young, {}
        for i, x in zip(missing, map(self.old.get, [words[i] for i in missing])):
            found[i] = x
        new = [i for i in missing if found[i] is None]
        for i, x in zip(new, self.encoder.words([words[i] for i in new])):
            found[i] = x
        self.young.update(zip([words[i] for i in missing], [found[i] for i in missing]))
        return found


def by_size(sizes, limit: int = CHUNK):
    """Slices (from, to) of rows in a row, of about ``limit`` in all or one row."""
    at = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield at, i
            at, total = i, 0
        total += size
    if len(sizes) > at:
        yield at, len(sizes)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(name: str, spaces: bool, cache_words: int = CACHE_WORDS, chunk: int = CHUNK) -> Encoder:
    """This worker's encoder of a vocabulary file of ``public_tokenizers``,
    or of a path."""
    key = (name, spaces, cache_words, chunk)
    if key not in _ENCODERS:
        pa.default_memory_pool().release_unused()  # what earlier stages left in this worker
        if os.path.sep in name:
            path = name
        else:
            import public_tokenizers

            path = public_tokenizers.path(name)
        _ENCODERS[key] = Encoder(path, spaces, cache_words, chunk)
    return _ENCODERS[key]
