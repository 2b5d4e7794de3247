"""Token counts and ids of whole texts, by tokenising each distinct word of a slice once.

count_tokens: the whole-token shortcut. Offline, on the driver, every vocabulary string that encodes alone as one token
is proven such by encoding it; these words are counted as one token where they stand, and only the other words of
a slice are merged by the library. A word here is a run of spaces with the letters after it. No vocabulary string
has a space mark after another character (checked on loading), so no merge can cross the start of such a run and
the counts of the words add up to the count of the text.

Words are told apart by two hashes of 64 bits each.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loomline.llm.common import Memo, distinct_words, id_and_text, ragged, spans, text_slices

MARK = "▁"
_ONLY_SPACE = np.zeros(256, dtype=bool)
_ONLY_SPACE[32] = True


@lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def whole_tokens(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The two hashes of the words that encode alone as one token, sorted; raises if words can't be counted one by one."""
    model = _pieces(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a vocabulary string goes across a space; words of this model can't be counted one by one")
    words = [p[1:] for p in pieces if p.startswith(MARK) and len(p) > 1 and MARK not in p[1:] and " " not in p]
    words = [w for w, ids in zip(words, model.encode(words, num_threads=1), strict=True) if len(ids) == 1]
    ends = np.cumsum([len(w.encode()) for w in words])
    return distinct_words(np.frombuffer("".join(words).encode(), np.uint8), np.r_[0, ends[:-1]], ends)[:2]


_counts: dict[str, Memo] = {}


def _piece_counts(data: np.ndarray, offsets: np.ndarray, path: str, whole: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Tokens of each row."""
    model = _pieces(path)
    if path not in _counts:
        _counts[path] = Memo(np.uint32)
    memo = _counts[path]
    starts, ends, first = spans(data, offsets, _ONLY_SPACE)
    total = np.zeros(len(offsets) - 1, np.int64)
    before = np.r_[0, ends[:-1]] if len(ends) else ends
    before[first[:-1][first[:-1] < first[1:]]] = offsets[:-1][first[:-1] < first[1:]]
    spaces = starts - before  # in front of each word
    leads = np.zeros(len(starts), bool)
    leads[first[:-1][first[:-1] < first[1:]]] = True
    extra = np.where(leads, spaces, spaces - 1)  # the library itself puts one space in front
    keys, checks, example, back = distinct_words(data, starts - extra, ends)
    memo.make_room(len(keys))
    n = np.zeros(len(keys), np.int64)
    if len(whole[0]):
        at = np.minimum(np.searchsorted(whole[0], keys), len(whole[0]) - 1)
        n[(whole[0][at] == keys) & (whole[1][at] == checks)] = 1
    rest = np.flatnonzero(n == 0)
    at, known = memo.find(keys[rest], checks[rest])
    n[rest[known]] = memo.flat[memo.starts[at[known]]]
    rest = rest[~known]
    if len(rest):
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip((starts - extra)[example[rest]].tolist(), ends[example[rest]].tolist(), strict=True)]
        n[rest] = [len(x) for x in model.encode(texts, num_threads=1)]
        memo.add(keys[rest], checks[rest], np.ones(len(rest), np.int64), n[rest])
    sums = np.r_[0, np.cumsum(n[back])]
    total += sums[first[1:]] - sums[first[:-1]]
    mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else []
    odd = set(np.searchsorted(offsets, mark, "right") - 1) if len(mark) else set()
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    ending = filled[data[offsets[filled + 1] - 1] == 32]
    for i in sorted(odd | set(ending)):  # the mark itself in a text, or spaces at its end: by the library as a whole
        total[i] = len(model.encode(data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")))
    return total


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text, as the sentencepiece model at model_path counts.

    Null or empty text: 0 tokens. Rows are taken one by one, so repeated rows come out as often as they came in;
    a null doc_id stays null. An empty table gives an empty result.
    """
    whole = whole_tokens(model_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                n = _piece_counts(data, offsets, model_path, whole)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: The split rule of the vocabulary file word_bpe_49k.json (fixed value).
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_PLAIN = regex.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: printable ones are themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


@lru_cache(maxsize=2)
def word_encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text without white space. Where the file's rules are those known here, plain words go to the BPE model directly, without the library's offsets and normalisers."""
    tokenizer = _tokenizer(path)
    model = tokenizer.model
    normalizer, splitter = repr(tokenizer.normalizer), repr(tokenizer.pre_tokenizer)
    direct = all(x in normalizer for x in ("NFC", "Replace", "Lowercase")) and _SPLIT.pattern.replace("\\p{L}+", "[\\p{L}]+").replace("|\\p{N}|", "|[\\p{N}]|") in splitter.replace("\\\\", "\\")

    def encode(word: str) -> list[int]:
        if direct and "<|" not in word and _PLAIN.fullmatch(word):
            out: list[int] = []
            for part in _SPLIT.findall(word.lower()):
                if not part.isascii():
                    part = "".join(_LETTERS[b] for b in part.encode())
                out += [t.id for t in model.tokenize(part)]
            return out
        return tokenizer.encode(word, add_special_tokens=False).ids

    return encode


_ids: dict[str, Memo] = {}


def encode_ids(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows in one array, and the offsets of the rows in it."""
    encode = word_encoder(path)
    if path not in _ids:
        _ids[path] = Memo(np.uint16 if _tokenizer(path).get_vocab_size() <= 1 << 16 else np.uint32)
    memo = _ids[path]
    starts, ends, first = spans(data, offsets)
    keys, checks, example, back = distinct_words(data, starts, ends)
    memo.make_room(len(keys))
    at, known = memo.find(keys, checks)
    begin, lengths = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    begin[known], lengths[known] = memo.starts[at[known]], memo.lengths[at[known]]
    flat = memo.flat
    new = np.flatnonzero(~known)
    if len(new):
        raw = data.tobytes()
        lists = [encode(raw[a:b].decode("utf-8", "replace")) for a, b in zip(starts[example[new]].tolist(), ends[example[new]].tolist(), strict=True)]
        lengths[new] = np.fromiter(map(len, lists), np.int64, len(lists))
        begin[new] = np.cumsum(lengths[new]) - lengths[new] + len(flat)
        memo.add(keys[new], checks[new], lengths[new], np.fromiter((x for ids in lists for x in ids), memo.kind, int(lengths[new].sum())))
        flat = memo.flat
    lengths = lengths[back]
    return flat[ragged(begin[back], lengths)], np.r_[0, np.cumsum(lengths)][first]


def crc32_of_ids(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
