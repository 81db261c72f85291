"""Token ids by the ``tokenizers`` library, a unit of text at a time.

A unit is a run of white space and the run of other characters behind it. Neither vocabulary used here has a token
that reaches over the start of such a unit (their splitting rules begin a new piece there), so the ids of a text are
those of its units, and a unit that was seen before needs no second encoding. Every id still comes from the library.
Texts in which a unit's ids could depend on its surroundings go to the library whole:

* those with ``<|``, which may begin a special token,
* those with U+001C to U+001F, white space for Python but not for the library's rules.

The memory of units is bounded: two generations of ``MEMORY`` units of at most ``LONGEST`` characters. When the
young one is full it becomes the old one; a unit found in the old one moves back.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import unicodedata
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMORY, LONGEST = 600_000, 48
#: New units that are encoded as one text; each begins with white space, so they do not touch one another.
JOINED = 128

_UNIT = re.compile(r"\s*\S+|\s+")
#: A word and the ASCII marks behind it (no apostrophe), which the rules always take apart.
_MARKED = re.compile(r"(\s*[^\W\d_]+)([!-&(-/:-@\[-^`{-~]+)\Z")
_WHOLE = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
#: Texts of ``encode_array`` that are encoded one by one: those of ``_WHOLE``, and white space beyond ASCII.
_ODD = r"<\||[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_LOADED: dict[str, Encoder] = {}


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on beside others, and its allocators would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


class Encoder:
    """Texts to little-endian ids, ``uint16`` where the vocabulary allows it and else ``uint32``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.normalizes = self.library.normalizer is not None
        vocabulary = self.library.get_vocab()
        suffix = getattr(self.library.model, "end_of_word_suffix", None) or ""
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # in these vocabularies a character of a token stands for a byte
            self.id_bytes[i] = len(token.removesuffix(suffix))
        self.calls = 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [
            np.array(e.ids, self.dtype).tobytes()
            for e in self.library.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _encode_units(self, units: list[str]) -> dict[str, bytes]:
        apart = [u for u in units if not u[0].isspace() or u[-1].isspace()]
        out = dict(zip(apart, self._encode(apart), strict=True))
        rest = [u for u in units if u[0].isspace() and not u[-1].isspace()]
        groups = [rest[i : i + JOINED] for i in range(0, len(rest), JOINED)]
        for group, e in zip(
            groups, self.library.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False), strict=True
        ):
            ids = np.array(e.ids, self.dtype)
            ends = np.cumsum(self.id_bytes[ids])
            want = np.cumsum([self._n_bytes(u) for u in group])
            cuts = np.searchsorted(ends, want)
            if ends[-1] == want[-1] and (ends[cuts] == want).all():
                packed, width = ids.tobytes(), self.dtype.itemsize
                cuts = ((cuts + 1) * width).tolist()
                for u, a, b in zip(group, [0, *cuts], cuts, strict=False):
                    out[u] = packed[a:b]
            else:
                out.update(zip(group, self._encode(group), strict=True))
        return out

    def _n_bytes(self, unit: str) -> int:
        """Bytes that the ids of a unit stand for: those of the unit, or of its normalised form without white space."""
        if not self.normalizes:
            return len(unit.encode())
        unit = unit.lstrip().lower()
        return len(unit) if unit.isascii() else len(unicodedata.normalize("NFC", unit).encode())

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """The ids of units that the young memory does not hold."""
        late = {u: self.old[u] for u in missing if u in self.old}
        parts: dict[str, tuple[str, str]] = {}
        rest: set[str] = set()
        for u in missing:
            if u not in late:
                if "İ" not in u and (m := _MARKED.match(u)):  # lower-cased, that letter ends in a mark
                    parts[u] = m.groups()
                    rest.update(p for p in m.groups() if p not in self.young)
                else:
                    rest.add(u)
        new = {u: self.old[u] for u in rest if u in self.old}
        new |= self._encode_units([u for u in rest if u not in new])
        for u, (word, marks) in parts.items():
            late[u] = (new.get(word) or self.young[word]) + (new.get(marks) or self.young[marks])
        return late | new

    def _remember(self, late: dict[str, bytes]) -> None:
        if len(self.young) + len(late) > MEMORY:
            self.old, self.young = self.young, {}
        self.young.update((u, x) for u, x in late.items() if len(u) <= LONGEST)
        self.calls += 1
        if self.calls % 16 == 0:
            give_back()

    def encode_array(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """The ids of each text with ``end`` behind them, as binaries; a null text has ``end`` alone.

        As ``encode``, but the units of all texts are cut and counted at once, and each distinct one is looked up once.
        Units begin at white space of ASCII; texts with other white space, or what goes to the library whole, take
        ``encode``."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        special = dict(zip(np.flatnonzero(odd).tolist(), self.encode(texts.filter(pa.array(odd)).to_pylist()), strict=True))
        plain = pc.if_else(pa.array(odd), "", texts) if special else texts
        n = len(plain)
        bounds = np.frombuffer(plain.buffers()[1], "<i4")[plain.offset : plain.offset + n + 1] if n else np.zeros(1, "<i4")
        data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        white = (data == 32) | ((data >= 9) & (data <= 13))
        begins = white.copy()
        begins[1:] &= ~white[:-1]
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(begins).astype("<i4")
        cuts = pa.py_buffer(np.append(starts, len(data)).astype("<i4"))
        units = pa.Array.from_buffers(pa.string(), len(starts), [None, cuts, pa.py_buffer(np.ascontiguousarray(data))])
        coded = units.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.young.get, names))
        late = self._learn({u for u, x in zip(names, ids, strict=True) if x is None})
        ids = [late[u] if x is None else x for u, x in zip(names, ids, strict=True)]
        self._remember(late)
        # Behind each text's units one more: its end, with the ids of a text that was encoded whole before it.
        ends = {i: x + end for i, x in special.items()}
        kinds = np.full(n, len(ids))
        kinds[list(ends)] = len(ids) + 1 + np.arange(len(ends))
        last = np.searchsorted(starts, bounds[1:])
        order = np.insert(coded.indices.to_numpy().astype(np.int64), last, kinds)
        taken = pa.array([*ids, end, *ends.values()], pa.large_binary()).take(pa.array(order))
        at = np.frombuffer(taken.buffers()[1], "<i8")[taken.offset : taken.offset + len(taken) + 1]
        rows = np.append(at[0], at[last + np.arange(n) + 1])
        return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(rows), taken.buffers()[2]])

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text, packed; a null text has none."""
        units = [None if not t or any(w in t for w in _WHOLE) else _UNIT.findall(t) for t in texts]
        found = [list(map(self.young.get, us)) if us else None for us in units]
        missing: set[str] = set()
        gaps: list[list[int]] = []
        for us, ids in zip(units, found, strict=True):
            gaps.append([])
            if ids and None in ids:
                at = -1
                with contextlib.suppress(ValueError):
                    while True:
                        at = ids.index(None, at + 1)
                        gaps[-1].append(at)
                missing.update([us[k] for k in gaps[-1]])
        late = self._learn(missing)
        out = []
        for text, us, ids, gap in zip(texts, units, found, gaps, strict=True):
            if ids is None:
                out.append(self._encode([text])[0] if text else b"")
                continue
            for k in gap:
                ids[k] = late[us[k]]
            out.append(b"".join(ids))
        self._remember(late)
        return out


def encoder(path: str) -> Encoder:
    """One for each Python worker and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids written as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
