"""Exact token counts and ids of a word-level byte-pair vocabulary, without encoding every word.

Whole-token shortcut: which vocabulary strings come out as one token when encoded alone is worked out once, on the
driver, by running the merges on each of them. Pre-tokens found among these need no merging; the others are merged, all distinct
ones of a slice at once, as rows of a numpy matrix, and pre-tokens of over ``LONG_LETTERS`` letters by the library. White space always ends a pre-token, so the result for a run between white
space is kept in a bounded cache and a text is the sum (or concatenation) over its runs.

The shortcut knows how the file at hand normalises and splits text for the characters in ``PLAIN``. A text with
any other character, or with the start of a special string, is encoded by the ``tokenizers`` library as a whole.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from stratalake.llm.common import map_texts

# Runs between white space whose tokens a worker keeps.
CACHE_RUNS = 400_000
# Bytes of the runs and tokens kept, beyond which the cache starts anew.
CACHE_BYTES = 64 << 20
# Pre-tokens beyond this many letters are merged by the library: merging them as rows takes time with the square of their length.
LONG_LETTERS = 256
SPECIAL_START = "<|"
PLAIN = re.compile("[\t-\r -~¡§©«®°·»¿À-įĲ-ňŊ-ž‐-‧€]*")
END = "</w>"
# Single marks that often end a run of letters; each is a pre-token of its own there.
MARKS = ",.;:!?"
# Fixed value: the pre-token pattern that the vocabulary file states, in the syntax of ``re`` for the PLAIN characters.
PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
NONE = np.int64(1) << 40


class WordVocabulary:
    """The vocabulary as arrays, and the strings proven to be one token. Size is bounded by the vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END:
            raise ValueError(f"{path} is not a byte-pair vocabulary with {END} at word ends")
        self.path = path
        ids = model["vocab"]
        self.letter = np.array([ids[c] for c in _byte_letters()], np.int64)
        self.last_letter = np.array([ids[c + END] for c in _byte_letters()], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pairs = np.array([(ids[a] << 20) | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.rank, self.made = pairs[order], order.astype(np.int64), made[order]
        self.whole = self._prove(ids)

    def _prove(self, ids: dict[str, int]) -> dict[str, bytes]:
        """Vocabulary strings at word ends that are one pre-token and whose merges end in that one token."""
        to_byte = {c: b for b, c in enumerate(_byte_letters())}
        claimed = {}
        for entry, number in ids.items():
            if not entry.endswith(END) or len(entry) == len(END):
                continue
            try:
                word = bytes(to_byte[c] for c in entry[: -len(END)]).decode()
            except UnicodeDecodeError:
                continue
            if word == word.lower() and PLAIN.fullmatch(word) and PRE_TOKEN.findall(word) == [word]:
                claimed[word] = number
        alone = {w: i.to_bytes(4, "little") for w, i in claimed.items()}
        return {w: ids for w, ids in self.merge(list(alone)).items() if ids == alone[w]}

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging neighbours; a rank of NONE where they do not merge."""
        wanted = (left << 20) | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        found = self.pairs[at] == wanted
        return np.where(found, self.rank[at], NONE), self.made[at]

    def merge(self, words: list[str]) -> dict[str, bytes]:
        """Token ids (little-endian unsigned 32-bit) of each word, a non-empty pre-token.

        Words of equal length are merged side by side.
        """
        encoded = [w.encode() for w in words]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        result = {}
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length).tolist()
            step = max(1, (1 << 19) // length)
            for start in range(0, len(rows), step):
                own = rows[start : start + step]
                raw = np.frombuffer(b"".join([encoded[i] for i in own]), np.uint8).reshape(len(own), length)
                symbols, sizes = self._merge_matrix(raw)
                flat = symbols[np.arange(length) < sizes[:, None]].astype("<u4").tobytes()
                ends = (4 * np.cumsum(sizes)).tolist()
                result.update(zip([words[i] for i in own], [flat[i:j] for i, j in zip([0, *ends], ends)]))
        return result

    def _merge_matrix(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apply the lowest-ranked, leftmost merge of every row until no row has one."""
        n, width = raw.shape
        symbols = self.letter[raw]
        symbols[:, -1] = self.last_letter[raw[:, -1]]
        sizes = np.full(n, width, np.int64)
        if width == 1:
            return symbols, sizes
        ranks, made = self._lookup(symbols[:, :-1], symbols[:, 1:])
        out = symbols.copy()
        live = np.arange(n)
        while len(live):
            at = ranks.argmin(1)
            each = np.arange(len(live))
            go = ranks[each, at] < NONE
            if not go.all():
                done = live[~go]
                out[done, : symbols.shape[1]] = symbols[~go]
                live, symbols, ranks, made, at = live[go], symbols[go], ranks[go], made[go], at[go]
                each = np.arange(len(live))
                if not len(live):
                    break
            symbols[each, at] = made[each, at]
            sizes[live] -= 1
            columns = np.arange(symbols.shape[1] - 1)
            moved = columns + (columns > at[:, None])
            symbols = np.take_along_axis(symbols, moved, 1)
            if symbols.shape[1] == 1:
                out[live, 0] = symbols[:, 0]
                break
            columns = columns[:-1]
            moved = columns + (columns >= at[:, None])
            ranks, made = np.take_along_axis(ranks, moved, 1), np.take_along_axis(made, moved, 1)
            for side in (at - 1, at):
                # The last column holds what slid in from the right; beyond a row's size nothing merges.
                ok = (side >= 0) & (side < sizes[live] - 1)
                rows, cols = each[ok], side[ok]
                ranks[rows, cols], made[rows, cols] = self._lookup(symbols[rows, cols], symbols[rows, cols + 1])
        return out, sizes


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte: itself if printable, else the next free one."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class WordEncoder:
    """Tokens of texts in one worker process."""

    def __init__(self, vocabulary: WordVocabulary):
        self.vocabulary = vocabulary
        self.ids: dict[str, bytes] = {}
        self.held = 0
        self.library = Tokenizer.from_file(vocabulary.path)
        self.library.no_truncation()
        self.library.no_padding()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's token ids as little-endian unsigned 32-bit numbers; a null text is empty."""
        runs = [(t or "").lower().split() if _is_plain(t) else None for t in texts]
        self._learn(set().union(*(own for own in runs if own)))
        get = self.ids.__getitem__
        result = [b"".join(map(get, own)) if own is not None else None for own in runs]
        other = [i for i, own in enumerate(runs) if own is None]
        for i, found in zip(other, self._by_library([texts[i] for i in other])):
            result[i] = found
        return result

    def _learn(self, runs: set[str]) -> None:
        """Take the tokens of these runs into the cache."""
        if len(self.ids) + len(runs) > CACHE_RUNS or self.held > CACHE_BYTES:
            self.ids, self.held = {}, 0
        new = runs - self.ids.keys()
        whole = self.vocabulary.whole
        words = {r for r in new if r.isalpha()}
        ended = [r for r in new if r[-1] in MARKS and r[:-1].isalpha()]
        split = {r: PRE_TOKEN.findall(r) for r in new - words - set(ended)}
        needed = words.union((r[:-1] for r in ended), *split.values())
        tokens = {w: whole[w] for w in needed & whole.keys()}
        rest = needed - whole.keys()
        long = [w for w in rest if len(w) > LONG_LETTERS]
        tokens.update(zip(long, self._by_library(long)))
        tokens.update(self.vocabulary.merge(list(rest.difference(long))))
        self.ids.update((w, tokens[w]) for w in words)
        marks = {m: whole.get(m) or self.vocabulary.merge([m])[m] for m in MARKS}
        self.ids.update((r, tokens[r[:-1]] + marks[r[-1]]) for r in ended)
        self.ids.update((r, b"".join([tokens[p] for p in own])) for r, own in split.items())
        self.held += sum(len(r) + len(self.ids[r]) for r in new)

    def _by_library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch(texts, add_special_tokens=False) if texts else []
        return [np.array(f.ids, "<u4").tobytes() for f in found]


def _is_plain(text: str | None) -> bool:
    return not text or (PLAIN.fullmatch(text) is not None and SPECIAL_START not in text)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """This process's encoder; its cache lives as long as the worker."""
    return WordEncoder(WordVocabulary(path))


def token_counts(docs: DataFrame, vocabulary_path: str, over: int = 2048, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Count the tokens of every whole text: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``over``).

    Counts equal those of the library without added special tokens, truncation or padding. One row per row of
    ``docs``, repeated rows and null ids included; a null or empty text has 0 bytes and 0 tokens; other columns
    are not read. No shuffle: each scan task counts its own rows. The vocabulary file must exist on all nodes.
    """

    def count(ids: list, texts: list) -> list:
        tokens = [len(t) // 4 for t in encoder(vocabulary_path).encode(texts)]
        sizes = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
        return [ids, sizes, tokens, [n > over for n in tokens]]

    found = map_texts(docs, [_id(docs, id_column), _text(docs, text_column)], count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
    return found.withColumnRenamed("doc_id", id_column)


def _id(docs: DataFrame, name: str):
    return docs[name].cast("long").alias("doc_id")


def _text(docs: DataFrame, name: str):
    return docs[name].cast("string").alias("text")
