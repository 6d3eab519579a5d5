"""Token ids of whole texts, with each distinct word encoded once per worker.

The word vocabulary's tokenizer never joins anything over a space or a line feed, so a text's ids are the
ids of its space-separated words in order. Words are told apart by Arrow, distinct ones are encoded by the
tokenizers library, and their ids are kept in a table of bounded size for the texts that follow.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
#: Stems of words whose ids a worker keeps; the table starts anew beyond it.
KEPT_WORDS = 500_000
#: Bytes of text split at once, which bounds a task's memory; a longer text is cut at spaces.
TEXT_BYTES = 1 << 23

# The tokenizer's own pieces. A Latin-1 word can be cut into them here, as lower case and normal form
# change such letters one by one; other words go to the library whole.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")
_PLAIN = regex.compile(r"[\n!-~¡-ÿ]*")

#: Marks that are split off a word before it is looked up.
_MARKS = [",", "."]

_encoders: dict[str, WordEncoder] = {}


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for the UTF-8 bytes of each Latin-1 character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in set(plain))}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)}


class _Bank:
    """Ids of strings, each string by its number, one after the other in one array."""

    def __init__(self) -> None:
        self._strings = pa.array([], pa.large_string())
        self._ids = np.empty(1 << 16, np.uint32)
        self._ends = np.zeros(1 << 14, np.int64)  # of string number k, at k + 1

    def __len__(self) -> int:
        return len(self._strings)

    def append(self, strings: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        count, used = len(self), int(self._ends[len(self)])
        self._strings = pa.concat_arrays([self._strings, strings])
        if len(self._ids) < used + len(ids):
            self._ids = np.resize(self._ids, 2 * (used + len(ids)))
        if len(self._ends) <= len(self):
            self._ends = np.resize(self._ends, 2 * len(self) + 2)
        self._ids[used : used + len(ids)] = ids
        self._ends[count + 1 : len(self) + 1] = used + np.cumsum(sizes)

    def numbers(self, strings: pa.Array) -> np.ndarray:
        """The strings' numbers; -1 for those that are not here."""
        return np.array(pc.fill_null(pc.index_in(strings, value_set=self._strings), -1))

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the strings, one string after the other, and how many each has."""
        starts, sizes = self._ends[numbers], self._ends[numbers + 1] - self._ends[numbers]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
        return self._ids[places], sizes


class WordEncoder:
    """Ids of words by one vocabulary file."""

    def __init__(self, vocabulary: str) -> None:
        self._library = Tokenizer.from_file(vocabulary)
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._letters = _byte_letters()
        self._stems = _Bank()
        marks = [self._library.encode(m, add_special_tokens=False).ids for m in _MARKS]
        self._marks = np.array([ids[0] for ids in marks], np.uint32) if all(len(ids) == 1 for ids in marks) else None
        self._apart: dict[str, bool] = {"": False}

    def _learn(self, strings: pa.Array) -> np.ndarray:
        """Add stems that are not in the table yet; their numbers."""
        stems = strings.to_pylist()
        first, odd = len(self._stems), np.zeros(len(stems), bool)
        joined = "\n".join(stems)
        if not _PLAIN.fullmatch(joined) or any(s in joined for s in self._special):
            odd = np.array([not _PLAIN.fullmatch(w) or any(s in w for s in self._special) for w in stems])
            own = strings.filter(pa.array(odd))
            ids = [np.array(e.ids, np.uint32) for e in self._library.encode_batch_fast(own.to_pylist(), add_special_tokens=False)]
            self._stems.append(own, np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)))
            strings = strings.filter(pa.array(~odd))
            joined = "\n".join(strings.to_pylist())
        order = np.argsort(~odd, kind="stable")  # odd ones come first in the table
        numbers = np.empty(len(odd), np.int64)
        numbers[order] = first + np.arange(len(odd))
        if not len(strings):
            return numbers
        pieces = pa.array(_PIECES.findall(joined.lower()), pa.large_string()).dictionary_encode()
        tokenize, letters = self._library.model.tokenize, self._letters
        ids, sizes = [], []
        for piece in pieces.dictionary.to_pylist():
            tokens = [] if piece == "\n" else tokenize(piece.translate(letters))
            ids += [token.id for token in tokens]
            sizes.append(len(tokens))
        bank = _Bank()
        bank.append(pieces.dictionary, np.array(ids, np.uint32), np.array(sizes, np.int64))
        which = pieces.indices.to_numpy()
        ids, sizes = bank.of(which)
        breaks = np.asarray(pc.equal(pieces.dictionary, "\n").to_numpy(zero_copy_only=False), bool)[which]
        self._stems.append(strings, ids, np.diff(np.append(np.cumsum(sizes)[breaks], len(ids)), prepend=0))
        return numbers

    def _number(self, stems: pa.Array) -> np.ndarray:
        """Numbers of distinct stems, which are learned if they are new."""
        numbers = self._stems.numbers(stems)
        missing = numbers < 0
        if missing.any():
            if len(self._stems) + missing.sum() > KEPT_WORDS and len(self._stems):
                self._stems = _Bank()
                missing[:] = True
            numbers[missing] = self._learn(stems.filter(pa.array(missing)))
        return numbers

    def mark_apart(self, letter: str) -> bool:
        """Whether a mark after this character is a piece of its own.

        The library's normal form can end a letter in a combining mark, which joins the punctuation after it,
        so the library itself is asked, once for each character.
        """
        if letter not in self._apart:
            ids = [self._library.encode(letter + m, add_special_tokens=False).ids for m in ["", *_MARKS]]
            self._apart[letter] = letter.isalpha() and all(i == [*ids[0], mark] for i, mark in zip(ids[1:], self._marks.tolist()))
        return self._apart[letter]

    def _marked(self, words: pa.Array, last: pa.Array) -> np.ndarray:
        """Which words end in a mark that is a piece of its own."""
        marked = last.is_valid().to_numpy(zero_copy_only=False)
        if self._marks is None or not marked.any():
            return np.zeros(len(words), bool)
        before = pc.utf8_slice_codeunits(words.filter(pa.array(marked)), -2, -1).dictionary_encode()
        apart = np.array([self.mark_apart(c) for c in before.dictionary.to_pylist()], bool)
        marked[marked] = apart[before.indices.to_numpy()]
        return marked

    def _ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one word after the other, and how many each has.

        A comma or full stop after most letters is a piece of its own, and A-Z are lowered by the tokenizer
        anyway, so the table holds lower-case stems.
        """
        last = pc.index_in(pc.utf8_slice_codeunits(words, -1), value_set=pa.array(_MARKS, words.type))
        marked = self._marked(words, last)
        stems = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(words, 0, -1), words)
        # Lower case must not make an ordinary text out to be a special token.
        stems = pc.if_else(pc.match_substring(stems, "<"), stems, pc.ascii_lower(stems)).dictionary_encode()
        numbers = self._number(stems.dictionary)[stems.indices.to_numpy()]
        ids, sizes = self._stems.of(numbers)
        if marked.any():
            which = last.filter(pa.array(marked)).to_numpy()
            ids = np.insert(ids, np.cumsum(sizes)[marked], self._marks[which])
            sizes = sizes + marked
        return ids, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty), and each text's number of ids."""
        words = pc.split_pattern(pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " "), " ")
        per_text = np.diff(words.offsets.to_numpy())
        coded = words.flatten().dictionary_encode()
        ids, sizes = self._ids_of(coded.dictionary)
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids)).take(coded.indices)
        ends = ids.offsets.to_numpy()
        bounds = ends[np.concatenate([[0], np.cumsum(per_text)])]
        return ids.flatten().to_numpy(), np.diff(bounds)


def encoder(vocabulary: str) -> WordEncoder:
    """This worker process's encoder for a vocabulary."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = WordEncoder(vocabulary)
    return _encoders[vocabulary]


def _cut(text: str) -> list[str]:
    """A long text in pieces of bounded size, cut at spaces only; concatenated ids stay the same."""
    parts, start = [], 0
    while len(text) - start > TEXT_BYTES // 4:
        at = max(text.rfind(" ", start + 1, start + TEXT_BYTES // 4), text.rfind("\n", start + 1, start + TEXT_BYTES // 4))
        if at < 0:
            at = min((p for p in (text.find(" ", start + 1), text.find("\n", start + 1)) if p > 0), default=len(text))
        parts.append(text[start:at])
        start = at
    parts.append(text[start:])
    return parts


def encode_all(texts: pa.Array, vocabulary: str = VOCABULARY, end_id: int | None = END_ID) -> list[np.ndarray]:
    """Ids (unsigned 32-bit) of each text with ``end_id`` after it; null counts as empty."""
    words = encoder(vocabulary)
    tail = np.array([] if end_id is None else [end_id], np.uint32)
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    out: list[np.ndarray] = []
    start = 0
    while start < len(texts):
        if sizes[start] > TEXT_BYTES:
            ids = [words.encode(pa.array([p]))[0] for p in _cut(texts[start].as_py())]
            out.append(np.concatenate([*ids, tail]))
            start += 1
            continue
        stop, size = start, 0
        while stop < len(texts) and (size + sizes[stop] <= TEXT_BYTES or stop == start) and sizes[stop] <= TEXT_BYTES:
            size += sizes[stop]
            stop += 1
        ids, counts = words.encode(texts.slice(start, stop - start))
        edges = np.concatenate([[0], np.cumsum(counts)])
        out += [np.concatenate([ids[a:b], tail]) for a, b in zip(edges, edges[1:])]
        start = stop
    pa.default_memory_pool().release_unused()  # workers stay, and later stages need the memory
    return out
