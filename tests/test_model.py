"""The model hook with a real (tiny) tokenizer and ONNX file.

The model looks each token up in a table, so the expected vector of a text is
the unit-length mean of its tokens' table rows.
"""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vicinity.functions.encode import OnnxModel, encode, encode_text

WORDS = ["[PAD]", "[UNK]", "lemon", "peel", "oak", "smoke"]
TABLE = np.arange(1, 25, dtype="float32").reshape(6, 4) % 7


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    """One protobuf field: an int, a string or an embedded message."""
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    data = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(data)) + data


def tensor_type(name, kind, dims):
    shape = b"".join(field(1, field(2, d)) for d in dims)
    return field(1, name) + field(2, field(1, field(1, kind) + field(2, shape)))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = tmp_path_factory.mktemp("model")
    words = Tokenizer(models.WordLevel({w: i for i, w in enumerate(WORDS)}, unk_token="[UNK]"))
    words.pre_tokenizer = pre_tokenizers.Whitespace()
    words.save(str(path / "tokenizer.json"))

    int64, float32 = 7, 1
    table = field(1, 6) + field(1, 4) + field(2, float32) + field(8, "table") + field(9, TABLE.tobytes())
    node = field(1, "table") + field(1, "input_ids") + field(2, "states") + field(4, "Gather")
    graph = field(1, node) + field(2, "lookup") + field(5, table)
    for name in ("input_ids", "attention_mask"):
        graph += field(11, tensor_type(name, int64, ["rows", "tokens"]))
    graph += field(12, tensor_type("states", float32, ["rows", "tokens", "width"]))
    model = field(1, 8) + field(7, graph) + field(8, field(1, "") + field(2, 13))
    (path / "model.onnx").write_bytes(model)
    return str(path)


def expected(*ids):
    mean = TABLE[list(ids)].astype("float64").mean(axis=0)
    return mean / np.linalg.norm(mean)


def test_mean_over_real_tokens_of_the_whole_text(folder):
    model = OnnxModel(folder, width=4, max_tokens=3)
    texts = ["lemon peel", "oak", "lemon peel oak smoke smoke lemon oak", "unknown lemon", ""]
    got = model.encode(texts)
    assert got[0] == pytest.approx(expected(2, 3), abs=1e-6)
    assert got[1] == pytest.approx(expected(4), abs=1e-6)
    assert got[2] == pytest.approx(expected(2, 3, 4, 5, 5, 2, 4), abs=1e-6)
    assert got[3] == pytest.approx(expected(1, 2), abs=1e-6)
    assert not got[4].any()


def test_column_prefix_and_query_agree(spark, folder):
    model = OnnxModel(folder, width=4)
    df = spark.createDataFrame([(1, "peel oak"), (2, None)] + [(i, "smoke") for i in range(3, 200)], "id long, t string")
    rows = df.select("id", encode(F.col("t"), model, prefix="lemon ").alias("v")).orderBy("id").collect()
    assert rows[0].v == pytest.approx(expected(2, 3, 4), abs=1e-6) and rows[1].v is None
    assert all(r.v == pytest.approx(expected(2, 5), abs=1e-6) for r in rows[2:])
    assert encode_text("peel oak", model, "lemon ") == pytest.approx(rows[0].v)
    info = dict(model.info())
    assert info["dimensions"] == "4" and info["model_file"] == "model.onnx" and int(info["model_bytes"]) > 100
