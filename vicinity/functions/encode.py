"""Text to vector: a deterministic built-in encoder and a model hook.

An encoder is any picklable object with ``width``, ``encode(texts) -> 2-d float
array`` and ``info() -> [(setting, value)]``. ``encode`` runs it over a column by
Arrow batches, so there is no shuffle and one model object per worker process.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Vector size, rows per model call, tokens per model window,
# lower bounds that keep divisions finite.
DEFAULT_WIDTH = 384
DEFAULT_BATCH = 64
MAX_TOKENS = 128
MIN_WEIGHT = 1e-9
MIN_NORM = 1e-12


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return (rows / np.maximum(lengths, MIN_NORM)[:, None]).astype("float32")


class _Slots(dict):
    """Slot of words seen of late by this worker process; not all that the table has."""

    most = 1 << 17

    def __init__(self, width: int):
        super().__init__({"": -1})
        self.width = width

    def __missing__(self, word: str) -> int:
        if len(self) > self.most:
            self.clear()
            self[""] = -1
        slot = int.from_bytes(hashlib.md5(word.encode()).digest()[:4]) % self.width
        self[word] = slot
        return slot


class HashedWords:
    """Bag of words folded into ``width`` slots, unit length.

    A word is a run of letters and digits in lower case; its slot is the first
    eight hex digits of its MD5, modulo the width. It compares wording, not
    meaning: texts without a common word are orthogonal (up to slot clashes).
    """

    chunk = 512

    def __init__(self, width: int = DEFAULT_WIDTH):
        self.width = width

    def encode(self, texts) -> np.ndarray:
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        words = pc.split_pattern_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}]+")
        owner = pc.list_parent_indices(words).to_numpy()
        coded = pc.list_flatten(words).dictionary_encode()
        known = loaded(("slots", self.width), lambda: _Slots(self.width))
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        slots = np.fromiter(map(known.__getitem__, distinct), "int64", len(distinct))
        slot = slots[coded.indices.to_numpy()]
        cell = (owner * self.width + slot)[slot >= 0]
        counts = np.bincount(cell, minlength=len(texts) * self.width)
        return _unit(counts.reshape(len(texts), self.width).astype("float64"))

    def info(self) -> list[tuple[str, str]]:
        return [
            ("model", "hashed-words"),
            ("dimensions", str(self.width)),
            ("max_seq_length", "unlimited"),
        ]


class OnnxModel:
    """Sentence model in ONNX form, mean-pooled over its tokens, unit length.

    Texts longer than one window are cut into windows of ``max_tokens`` and the
    mean runs over the tokens of all windows, so the whole text counts.
    """

    chunk = DEFAULT_BATCH

    def __init__(self, folder: str, width: int = DEFAULT_WIDTH, max_tokens: int = MAX_TOKENS):
        self.folder, self.width, self.max_tokens = folder, width, max_tokens

    def _open(self):
        import onnxruntime
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(f"{self.folder}/tokenizer.json")
        tokenizer.enable_truncation(max_length=self.max_tokens)
        tokenizer.enable_padding(pad_id=0, pad_token="[PAD]")
        session = onnxruntime.InferenceSession(
            f"{self.folder}/model.onnx", providers=["CPUExecutionProvider"]
        )
        return tokenizer, session

    def encode(self, texts) -> np.ndarray:
        texts = texts if isinstance(texts, list) else texts.to_pylist()
        tokenizer, session = loaded(("onnx", self.folder, self.max_tokens), self._open)
        owner, windows = [], []
        for row, first in enumerate(tokenizer.encode_batch(texts)):
            for window in (first, *first.overflowing):
                owner.append(row)
                windows.append(window)
        total = np.zeros((len(texts), self.width))
        weight = np.zeros(len(texts))
        for start in range(0, len(windows), self.chunk):
            part = windows[start : start + self.chunk]
            size = max(len(w.ids) for w in part)

            def padded(field, part=part, size=size):
                return np.array([f + [0] * (size - len(f)) for f in (getattr(w, field) for w in part)])

            mask = padded("attention_mask")
            offered = {
                "input_ids": padded("ids"),
                "attention_mask": mask,
                "token_type_ids": padded("type_ids"),
            }
            names = [i.name for i in session.get_inputs()]
            states = session.run(None, {k: offered[k] for k in names if k in offered})[0]
            rows = owner[start : start + self.chunk]
            np.add.at(total, rows, np.einsum("wts,wt->ws", states, mask.astype("float64")))
            np.add.at(weight, rows, mask.sum(axis=1))
        return _unit(total / np.maximum(weight, MIN_WEIGHT)[:, None])

    def info(self) -> list[tuple[str, str]]:
        import onnxruntime
        import tokenizers

        file = Path(self.folder) / "model.onnx"
        return [
            ("model", Path(self.folder).name),
            ("model_file", file.resolve().name),
            ("model_bytes", str(file.stat().st_size)),
            ("dimensions", str(self.width)),
            ("max_seq_length", str(self.max_tokens)),
            ("onnxruntime", onnxruntime.__version__),
            ("tokenizers", tokenizers.__version__),
        ]


_LOADED: dict[Any, Any] = {}


def loaded(key: Any, open_model: Callable[[], Any]) -> Any:
    """One model per key and worker process; Spark reuses its Python workers."""
    if key not in _LOADED:
        _LOADED[key] = open_model()
    return _LOADED[key]


def encode(text: Column, encoder=None, prefix: str = "") -> Column:
    """Vector of a text column; NULL stays NULL.

    ``prefix`` is the instruction some models want before a question or a
    document. Wrap the column in ``coalesce(text, '')`` to embed NULL as ''.
    """
    model = encoder or HashedWords()
    rows_per_call = getattr(model, "chunk", DEFAULT_BATCH)

    @F.arrow_udf("array<float>")
    def kernel(batch: pa.Array) -> pa.Array:
        missing = batch.is_null().to_numpy(zero_copy_only=False)
        texts = batch.drop_null()
        rows = np.empty((len(texts), model.width), "float32")
        for i in range(0, len(texts), rows_per_call):
            part = texts.slice(i, rows_per_call)
            if prefix:
                part = pc.binary_join_element_wise(pa.scalar(prefix), part, "")
            rows[i : i + rows_per_call] = model.encode(part)
        flat = rows.ravel()
        ends = np.concatenate([[0], np.cumsum(~missing) * model.width]).astype("int32")
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array(missing))

    return kernel(text)


def encode_text(text: str, encoder=None, prefix: str = "") -> list[float]:
    """Vector of one question, computed once where the query is written."""
    model = encoder or HashedWords()
    return [float(x) for x in np.asarray(model.encode([prefix + text]))[0]]


def encoder_info(spark: SparkSession, encoder=None) -> DataFrame:
    model = encoder or HashedWords()
    return spark.createDataFrame(model.info(), "setting string, value string")
