"""Exact token counts at every prefix of a text, by prefix dynamic programming.

A byte-pair encoding of a string ends in one token ``t``, and what stands before ``t`` is the
encoding of the shorter prefix. ``t`` is the one suffix in the vocabulary that encodes to itself
and stays apart from the token before it when the two are encoded together. So the last token and
the count of every prefix follow from those of shorter prefixes, with no prefix encoded again.

Texts are cut where no piece of the vocabulary reaches across: before a run of spaces, at line ends,
and between a word and a comma or full stop. Each part's steps (count at a prefix minus count one
character shorter) are computed once in a worker and looked up afterwards. The stored column holds
one signed byte for each character; sums of it answer truncation and budget questions.

Null and empty texts have no tokens and an empty column. Rows are handled one by one, so repeated
rows and ids give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.llm.text import text_groups

#: Parts and token pairs a worker keeps; emptied beyond that, which changes no count.
MOST_KEPT = 300_000
MOST_PAIRS = 400_000
#: Longer parts (unbroken junk) are computed and not kept.
LONG_PART = 64
NEVER = float("-inf")

_CUT = re.compile(r"▁*[^\W_]+(?=[.,▁\n]|\Z)|\n|▁*[^▁\n]+|▁+")
_PLAIN = re.compile(r"▁*[^▁]+|▁+")
_models: dict[str, PrefixModel] = {}


class PrefixModel:
    """Vocabulary of a sentencepiece BPE file with byte fallback and no normalisation."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal, kind = model.normalizer_spec, proto.ModelProto.SentencePiece
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("needs a BPE model with byte fallback")
        if normal.name != "identity" or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("needs a model that leaves the text as it is")
        self.dummy = normal.add_dummy_prefix
        self.score = {p.piece: p.score for p in model.pieces if p.type == kind.NORMAL}
        if len(self.score) + sum(p.type in (kind.BYTE, kind.UNKNOWN, kind.CONTROL) for p in model.pieces) != len(model.pieces):
            raise ValueError("pieces given by users are not supported")
        long = [p for p in self.score if len(p) > 1]
        if any("▁" in p.lstrip("▁") for p in long):
            raise ValueError("a piece has a space within")
        self.cut = _PLAIN if any("\n" in p or re.search(r"[^\W_][.,]|[.,][^\W_]", p) for p in long) else _CUT
        self.steps: dict[str, bytes] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self.traces: dict[str, list[tuple[float, str, str]]] = {}
        self.pieces = ahocorasick.Automaton()
        for piece in self.score:
            if len(piece) == 1 or len(self._trace(piece)) == len(piece) - 1:  # it encodes to itself
                self.pieces.add_word(piece, piece)
        self.pieces.make_automaton()

    def _trace(self, piece: str) -> list[tuple[float, str, str]]:
        """The greedy merges of a short string: best score first, leftmost among equals.

        Each as its score and what then stands first and last.
        """
        known = self.traces.get(piece)
        if known is None:
            parts, known = list(piece), []
            while len(parts) > 1:
                scores = [self.score.get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
                best = max(scores)
                if best == NEVER:
                    break
                k = scores.index(best)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                known.append((best, parts[0], parts[-1]))
            self.traces[piece] = known
        return known

    def _stay_apart(self, a: str, b: str) -> bool:
        """Whether two tokens side by side encode to themselves: no merge across comes before their own."""
        left, right, i, j = self._trace(a), self._trace(b), 0, 0
        last, first = a[-1], b[0]
        while True:
            across = self.score.get(last + first, NEVER)
            in_a = left[i][0] if i < len(left) else NEVER
            in_b = right[j][0] if j < len(right) else NEVER
            if across > in_a and across >= in_b:
                return False
            if in_a == in_b == NEVER:
                return True
            if in_a >= in_b:
                last, i = left[i][2], i + 1
            else:
                first, j = right[j][1], j + 1

    def compute(self, part: str) -> bytes:
        """The steps of one part, prefix by prefix."""
        last, count, steps = [""] * (len(part) + 1), [0] * (len(part) + 1), bytearray()
        apart, done = self.apart, 0

        def alone(upto: int) -> None:
            # Characters outside the vocabulary fall back to their bytes.
            for i in range(done + 1, upto + 1):
                last[i], count[i] = part[i - 1], count[i - 1] + len(part[i - 1].encode())

        for end, piece in self.pieces.iter(part):
            end += 1
            if last[end]:
                continue  # the one token that fits is found
            if end - 1 > done:
                alone(end - 1)
                done = end - 1
            begin = end - len(piece)
            if begin:
                pair = (last[begin], piece)
                fits = apart.get(pair)
                if fits is None:
                    if len(apart) > MOST_PAIRS:
                        apart.clear()
                    fits = apart[pair] = self._stay_apart(*pair)
                if not fits:
                    continue
            last[end], count[end], done = piece, count[begin] + 1, end
        alone(len(part))
        for a, b in zip(count, count[1:], strict=False):
            steps.append(b - a & 255)
        return bytes(steps)

    def part_steps(self, part: str) -> bytes:
        known = self.steps.get(part)
        if known is None:
            known = self.compute(part)
            if len(part) <= LONG_PART:
                if len(self.steps) > MOST_KEPT:
                    self.steps.clear()
                self.steps[part] = known
        return known

    def text_steps(self, text: str) -> bytes:
        """For each character, the count with it minus the count without it."""
        if not text:
            return b""
        shown = text.replace(" ", "▁")
        steps = b"".join(map(self.part_steps, self.cut.findall("▁" + shown if self.dummy else shown)))
        if not self.dummy:
            return steps
        # The empty text has no tokens, so the space put before it counts with the first character.
        first = np.frombuffer(steps[:2], np.int8).sum().astype(np.int8)
        return first.tobytes() + steps[2:]


def model(path: str) -> PrefixModel:
    """The model of a file, loaded once in a worker."""
    if path not in _models:
        _models[path] = PrefixModel(path)
    return _models[path]


def prefix_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", keep_steps: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_chars, n_tokens and, unless left out, steps (binary, a signed byte per character)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = model(path)
        for part, texts in text_groups(batches, text_column):
            steps = [prefix.text_steps(x.decode()) for x in texts]
            columns = [
                part.column(id_column).cast(pa.int64()),
                pa.array([len(x) for x in texts], pa.int64()),
                pa.array([len(x) for x in steps], pa.int64()),
                pa.array([int(np.frombuffer(x, np.int8).sum(dtype=np.int64)) for x in steps], pa.int64()),
            ]
            names = ["doc_id", "n_bytes", "n_chars", "n_tokens"]
            if keep_steps:
                columns.append(pa.array(steps, pa.binary()))
                names.append("steps")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, n_bytes bigint, n_chars bigint, n_tokens bigint" + ", steps binary" * keep_steps
    return docs.select(id_column, text_column).mapInArrow(count, schema)


@F.pandas_udf(T.LongType())
def tokens_at(steps: pd.Series, chars: pd.Series) -> pd.Series:
    """The token count of the first ``chars`` characters, from the stored steps."""
    return steps.combine(chars, lambda s, n: int(np.frombuffer(s, np.int8)[: max(0, int(n))].sum(dtype=np.int64)))


@F.pandas_udf(T.LongType())
def longest_prefix(steps: pd.Series, budget: pd.Series) -> pd.Series:
    """The most characters of a prefix that has at most ``budget`` tokens."""

    def longest(s: bytes, most: int) -> int:
        fits = np.flatnonzero(np.r_[0, np.cumsum(np.frombuffer(s, np.int8), dtype=np.int64)] <= most)
        return int(fits[-1]) if len(fits) else 0

    return steps.combine(budget, longest)
