"""Whole-text encoding with the tokenizers library, one vocabulary look-up a word.

The pre-tokenizers of both vocabularies never join text across a single space
or line break that stands between two non-space characters, so a text's ids
are the ids of its space-delimited chunks, joined. Each worker keeps a bounded
dictionary from chunk to ids; only chunks not in it reach the tokenizer. Where
white space is doubled or unusual, larger chunks (up to the whole text) go to
the tokenizer, so the result always equals encoding the whole text at once.
Where white space is dropped, Arrow finds the distinct chunks of many plain texts
at a time, and only those are looked up.
"""

from __future__ import annotations

import codecs
import gc
import os
import re
from array import array
from itertools import chain, compress, count, islice
from operator import attrgetter, not_

import numpy as np

_TWO_SPACES = re.compile(r"\s\s")
#: White space beside blank and line break.
_OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_LONE_SPACE = re.compile(r"(?<!\s) (?!\s)")
#: Text that normalisation to composed characters leaves as it is and whose lower case is that of its characters.
_PLAIN = re.compile("[\t-\r -~\xa0-\u017f]*")
#: Of chunks joined by NUL, each in turn: a line break, letters of the plain range, and up to eight stops (ASCII punctuation but the
#: apostrophe, which the pre-tokenizers join to letters); nothing of others.
_PARTS = re.compile("(\n?)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u0148\u014a-\u017f]++)([!-&(-/:-@[-`{-~]{0,8})(?:\0|\\Z)|[^\0]*(?:\0|\\Z)")
_SEPARATORS = re.compile("[\x1c-\x1f]")   # white space to Python, symbols to the tokenizer
#: Bytes between the chunks of plain texts that are joined by NUL.
_BETWEEN = bytes([0, *range(9, 14), 32])
#: ASCII punctuation but the apostrophe: after a letter, it begins a piece of its own.
_STOPS = np.array([33 <= b < 127 and not chr(b).isalnum() and b != 39 for b in range(256)])
#: Bytes of text that are encoded at a time.
SLAB = 8 << 20
_token_id = attrgetter("id")


def _doubled(text: str) -> bool:
    """Whether white space follows white space."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return True
    return bool(_OTHER_SPACE.search(text) and _TWO_SPACES.search(text))


class ChunkEncoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes.

    ``spaces`` says whether a chunk's ids depend on a space before it (byte
    level) or white space is dropped. The dictionary is cut back to its
    ``KEEP`` oldest entries (frequent words come early) whenever it holds more
    than ``MOST`` (some 150 bytes each). A null text is the empty text. Control strings in a text are
    ordinary text.
    """

    MOST, KEEP = 700_000, 200_000

    def __init__(self, path: str, spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one task a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaces = spaces
        self.model = self.tokenizer.model
        self.around: dict[str, bytes] = {}   # line breaks and stops around words
        self.known: dict[str, bytes] = {}    # by chunk; a space before it is left out, a line break is not

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _new(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of distinct chunks; those of letters and stops straight from the model, each spelling of letters once.

        The pre-tokenizer cuts such a chunk into its letters (with the space
        before them) and its stops, and the normaliser only lowers its case.
        Letters that are a known chunk have its ids.
        """
        plain, rest = [], []
        for w in chunks:
            if w.isalpha() and w.isascii():     # most: their parts need no search
                plain.append(w)
            elif "\0" not in w:
                rest.append(w)
        parts = [(w, *x) for w, x in zip(rest, _PARTS.findall("\0".join(rest))) if x[1]]
        plain += [w for w, _, letters, _ in parts if w == letters]
        parts = [x for x in parts if x[0] != x[2]]
        if self.spaces:
            alone = [" " + w for w in plain]
            words = [letters if line else " " + letters for _, line, letters, _ in parts]
            known = {word: self.known.get(letters) for word, (_, line, letters, _) in zip(words, parts) if not line}
        else:
            alone = [w.lower() for w in plain]
            words = [letters.lower() for _, _, letters, _ in parts]
            known = dict(zip(words, map(self.known.get, words)))
        unknown = [w for w in dict.fromkeys(chain(alone, words)) if not known.get(w)]
        ids = known | dict(zip(unknown, self._spellings(unknown)))
        if len(self.around) > 50_000:
            self.around.clear()
        sides = list({x for _, line, _, stops in parts for x in (line, stops)} - self.around.keys())
        self.around.update(zip(sides, self._ids(sides)))
        around, before = self.around, " " if self.spaces else ""
        out = dict(zip(plain, map(ids.__getitem__, alone)))
        out.update((w, around[line] + ids[word] + around[stops]) for (w, line, _, stops), word in zip(parts, words))
        odd = [w for w in chunks if w not in out]
        out.update(zip(odd, self._ids([w if w[:1] == "\n" else before + w for w in odd])))
        return out

    def _spellings(self, words: list[str]) -> list[bytes]:
        """Ids of letters, with the space before them where it counts."""
        out, tokenize = [], self.model.tokenize
        spelt = codecs.charmap_decode("\n".join(words).encode(), "strict", _BYTES)[0].split(_BREAK) if words else []
        for low in range(0, len(spelt), 20_000):        # few token objects at a time
            found = list(map(tokenize, spelt[low:low + 20_000]))
            ids = np.fromiter(map(_token_id, chain.from_iterable(found)), "<u4").tobytes()
            at = 0
            for n in map(len, found):
                out.append(ids[at:at + 4 * n])
                at += 4 * n
        return out

    def _chunks(self, text: str | None) -> tuple[str, list[str]]:
        """What stands at the start of the text, and the chunks that follow."""
        if not text:
            return "", []
        if not self.spaces:
            return (text, []) if _SEPARATORS.search(text) else ("", text.split())
        parts = _LONE_SPACE.split(text) if _doubled(text) else text.replace("\n", " \n").split(" ")
        return parts[0], parts[1:]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        collects = gc.isenabled()
        gc.disable()        # millions of small tuples and lists, none in a cycle: looking for cycles is a seventh of the time
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > self.MOST:
            self.known = dict(islice(self.known.items(), self.KEEP))
        if self.spaces:
            return self._by_text(texts)
        plain = [bool(text and _PLAIN.fullmatch(text)) for text in texts]
        both = {True: iter(self._by_slab(list(compress(texts, plain)))), False: iter(self._by_text(list(compress(texts, map(not_, plain)))))}
        return [next(both[x]) for x in plain]

    def _by_slab(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts without regard to spaces: their distinct chunks are looked up once."""
        import pyarrow as pa

        if not texts:
            return []
        slab = "\0".join(texts).replace("\xa0", " ").encode().lower()       # of ASCII: the normaliser's own step, for fewer distinct chunks
        letters = np.frombuffer(slab, np.uint8)
        between = letters <= 32                                 # white space and NUL: plain texts hold no other such byte
        cut = between.copy()
        cut[1:] |= (letters[:-1] - np.uint8(97) < 26) & _STOPS.take(letters[1:])    # stops are chunks of their own: fewer distinct ones
        cut = np.flatnonzero(cut)
        last = np.append(np.flatnonzero(letters.take(cut) == 0), len(cut))          # each text's last chunk
        gone = between.take(cut)
        slab = slab.translate(None, _BETWEEN)
        ends = np.concatenate(([0], cut - (np.cumsum(gone) - gone), [len(slab)]))
        chunks = pa.Array.from_buffers(pa.large_utf8(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(slab)]).dictionary_encode()
        own = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, own))
        places = [i for i, ids in enumerate(found) if ids is None]
        new = self._new([own[i] for i in places if own[i]])
        for i in places:
            found[i] = new.get(own[i], b"")                     # nothing stands between two spaces
        self.known.update(new)
        ids = pa.array(found, pa.large_binary()).take(chunks.indices)
        _, places, ids = ids.buffers()
        stops = np.frombuffer(places, np.int64)[last + 1].tolist()
        return [bytes(ids[a:b]) for a, b in zip([0, *stops], stops)]

    def _by_text(self, texts: list[str | None]) -> list[bytes]:
        find, starts, rows, new, gaps = self.known.get, [], [], {}, []
        for text in texts:
            first, chunks = self._chunks(text)
            got = list(map(find, chunks))
            places = list(compress(count(), map(not_, got)))     # not known, or without ids
            if places:
                words = [chunks[i] for i in places]
                new.update(dict.fromkeys(words))
                gaps.append((got, places, words))
            starts.append(first)
            rows.append(got)
        if new:
            new.update(self._new(list(new)))
            for got, places, words in gaps:
                for i, word in zip(places, words):
                    got[i] = new[word]
            self.known.update(new)
        return [first + b"".join(got) for first, got in zip(self._ids(starts), rows)]


def _byte_letters() -> str:
    """The byte-level alphabet: printable Latin-1 characters stand for their byte, the other bytes follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return "".join(letters[b] for b in range(256))


_BYTES = _byte_letters()
_BREAK = _BYTES[10]
_encoders: dict[tuple, ChunkEncoder] = {}


def slabs(batch, column: int):
    """An Arrow batch in slices of about ``SLAB`` bytes of text (more for a longer text)."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(sizes // SLAB)) + 1).tolist(), len(batch)]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


#: Most and kept entries of a dictionary where a worker has the memory: rare words are encoded again less often.
ROOMY = 1_300_000, 500_000


def encoder(path: str, spaces: bool, words: tuple[int, int] = (ChunkEncoder.MOST, ChunkEncoder.KEEP)) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file (kept between tasks); ``words``: most and kept entries of its dictionary."""
    if (path, spaces) not in _encoders:
        _encoders[path, spaces] = ChunkEncoder(path, spaces)
    found = _encoders[path, spaces]
    found.MOST, found.KEEP = words
    return found
