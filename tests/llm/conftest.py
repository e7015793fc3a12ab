import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[n]) for n in (2, 1, 0)]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not Path(SF).exists():
        pytest.skip("no test tables")
    return SF


ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "plain words, twice; plain words, twice"),
    (5, "tabs\tand\n\nlines  \r\n end "),
    (6, "no break   thin　wide \x1c\x85 odd"),
    (7, "it's we'll I'd  3rd 12345 ½ ²"),
    (8, "a" * 5000 + " " + "ab" * 3000),
    (9, "<|endoftext|>middle<|endoftext|> end<|endoftext|"),
    (10, "Grüße, 世界! \U0001f600\U0001f468‍\U0001f469 é"),
    (11, "plain words, twice; plain words, twice"),
    (12, "﻿\x00\x01 nul"),
    (None, "no id"),
    (4, "a repeated id"),
    (13, "x  y   z  w"),
]


@pytest.fixture
def odd_docs(spark):
    rows = [(i, t, "xx", "src", 1, "clash") for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens string")
