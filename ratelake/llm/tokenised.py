"""Tokenised pieces of documents, for packing into sequences."""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import pairwise
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ratelake.llm.common import kept

_PUNCTUATION = frozenset(punctuation)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _is_lean(text: str) -> bool:
    return (text.isascii() or _is_latin(text)) and text == text.lower()


def spaced(text: str | None, special: list[str] | None = None) -> str:
    """The text with a space for each ASCII white space: word tokenizers never join across it, so words can be encoded one by one.

    With ``special`` (the special tokens of a tokenizer that lower-cases), Latin-1 texts are lower-cased first, which
    there does the same, unless that would make a special token.
    """
    text = text or ""
    if special is not None and (text.isascii() or _is_latin(text)):
        low = text.lower()
        text = text if any(s in low for s in special) else low
    for space in "\n\t\r\x0b\x0c":
        if space in text:
            text = text.replace(space, " ")
    return text


def _lean_form(tokenizer) -> tuple[object, np.ndarray] | None:  # noqa: ANN001 - tokenizers.Tokenizer
    """A tokenizer without normalizer and patterns, for lower-case Latin-1 words of letters only, and which ids end a word.

    Such words are one pre-token and normal already where the tokenizer composes, collapses white space, lower-cases
    and splits into runs of letters and other things. None for tokenizers of another kind.
    """
    spec = json.loads(tokenizer.to_str())
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    steps = {x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])}
    kinds = [(x["type"], x.get("behavior"), x.get("invert")) for x in split.get("pretokenizers", [])]
    suffix = model.get("end_of_word_suffix")
    if (
        not suffix
        or model.get("continuing_subword_prefix")
        or steps != {"NFC", "Replace", "Lowercase"}
        or kinds != [("Split", "Removed", True), ("ByteLevel", None, None)]
        or "|[\\p{L}]+|" not in split["pretokenizers"][0]["pattern"].get("Regex", "")
        or any(t["content"].isalpha() for t in spec["added_tokens"])
    ):
        return None
    from tokenizers import Tokenizer, models, pre_tokenizers

    same = {k: model[k] for k in ("dropout", "unk_token", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k) is not None}
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    # the memo asks for each word once, so the model's own cache would only cost time
    lean = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, **same))
    level = {k: split["pretokenizers"][1][k] for k in ("add_prefix_space", "trim_offsets", "use_regex")}
    lean.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(**level)])
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return lean, ends


class WordMemo:
    """Ids of words as little-endian 32-bit bytes; two generations of at most ``limit`` words each bound the memory."""

    def __init__(self, tokenizer_path: str, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core; the tokenizer's own threads would only wait
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        special = [(k, t.content) for k, t in sorted(self.tokenizer.get_added_tokens_decoder().items()) if t.special and not (t.lstrip or t.rstrip)]
        self.mark_id, self.mark = special[0] if special else (None, None)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if "Lowercase" in repr(self.tokenizer.normalizer) else None
        self.lean = _lean_form(self.tokenizer) if self.special is not None else None
        self.limit, self.young, self.old = limit, {"": b""}, {}

    def codes(self, texts: list[list[str]]) -> list[list[bytes]]:
        """Every text's words as their ids; each word is looked up once, and only new ones again."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {"": b""}
        self._learn(set().union(*texts).difference(self.young))
        ids_of = self.young.__getitem__
        return [list(map(ids_of, words)) for words in texts]

    def _not_old(self, words: set[str]) -> list[str]:
        """The words that the older generation lacks; the others are taken over."""
        some, found = list(words), list(map(self.old.get, words))
        self.young.update((w, ids) for w, ids in zip(some, found, strict=True) if ids is not None)
        return [w for w, ids in zip(some, found, strict=True) if ids is None]

    def _learn(self, words: set[str]) -> None:
        young = self.young
        unknown, joined = set(), []
        for w in self._not_old(words):
            if w[-1] in _PUNCTUATION and (stem := w.rstrip(punctuation)).isalpha():  # letters, then only symbols: the tokenizer splits there
                symbols = w[len(stem) :]
                joined.append((w, stem, symbols))
                if stem not in young:
                    unknown.add(stem)
                if symbols not in young:
                    unknown.add(symbols)
            else:
                unknown.add(w)
        self._encode(self._not_old(unknown))
        young.update((w, young[a] + young[b]) for w, a, b in joined)

    def _encode_letters(self, words: list[str]) -> None:
        tokenizer, is_end = self.lean
        for lo in range(0, len(words), 500):
            part = words[lo : lo + 500]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            raw, begin = ids.tobytes(), 0
            for w, end in zip(part, (np.flatnonzero(is_end[ids]) + 1).tolist(), strict=True):
                self.young[w] = raw[4 * begin : 4 * end]
                begin = end

    def _encode(self, unknown: list[str]) -> None:
        if self.lean is not None:
            letters, unknown = [w for w in unknown if w.isalpha()], [w for w in unknown if not w.isalpha()]
            if not _is_lean(" ".join(letters)):
                unknown += [w for w in letters if not _is_lean(w)]
                letters = list(filter(_is_lean, letters))
            self._encode_letters(letters)
        if self.mark is None:
            coded = [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(unknown, add_special_tokens=False)]
            self.young.update(zip(unknown, coded, strict=True))
            return
        plain = [w for w in unknown if self.mark not in w]
        for lo in range(0, len(plain), 2000):
            # One text of many words: no id crosses the special token between two words.
            part = plain[lo : lo + 2000]
            ids = np.array(self.tokenizer.encode(self.mark.join(part), add_special_tokens=False).ids, dtype="<u4")
            raw, ends = ids.tobytes(), [*np.flatnonzero(ids == self.mark_id).tolist(), len(ids)]
            begin = 0
            for w, end in zip(part, ends, strict=True):
                self.young[w] = raw[4 * begin : 4 * end]
                begin = end + 1
        for w in unknown:
            if self.mark in w:
                self.young[w] = array("I", self.tokenizer.encode(w, add_special_tokens=False).ids).tobytes()


def _coded(texts: list[str], memo: WordMemo) -> list[bytes]:
    """Every text's ids. Arrow splits the texts and numbers their words, so the memo is asked for each word once."""
    split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    words = split.values.dictionary_encode()
    code = memo.codes([words.dictionary.to_numpy(zero_copy_only=False).tolist()])[0]
    size = np.fromiter(map(len, code), np.int64, len(code)) // 4
    ids, first = np.frombuffer(b"".join(code), dtype="<u4"), np.cumsum(size) - size
    word = words.indices.to_numpy()
    n = size[word]
    ends = np.concatenate(([0], np.cumsum(n)))
    raw = ids[np.repeat(first[word] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
    bounds = (4 * ends[split.offsets.to_numpy()]).tolist()
    return [raw[a:b] for a, b in pairwise(bounds)]


def memo_for(path: str) -> WordMemo:
    return kept(("words", path), lambda: WordMemo(path))


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each text's ids plus ``end_id``, cut only when longer than ``max_tokens``.

    A NULL text is empty and gives the one id ``end_id``. The whole text is
    tokenised; extra columns are not read. Runs per Arrow batch in the tasks
    that read the documents, without a shuffle.
    """
    end, width = int(end_id).to_bytes(4, "little"), 4 * max_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = memo_for(tokenizer_path)
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                ids = batch.column(0).to_pylist()
                texts = [spaced(t, memo.special) for t in batch.column(1).to_pylist()]
                out: list[tuple] = []
                for doc_id, coded in zip(ids, _coded(texts, memo), strict=True):
                    coded += end
                    for k, at in enumerate(range(0, len(coded), width)):
                        part = coded[at : at + width]
                        out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)
