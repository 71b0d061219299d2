"""Quoted secrets of any length."""

import random
import string

import pytest

from curio.llm import surrogates


@pytest.mark.parametrize("size", [200, 201, 1000])
def test_long_secret(spark, size):
    secret = "".join(random.Random(size).choices(string.ascii_letters + string.digits + "._-", k=size))
    docs = spark.createDataFrame([(1, f'a token = "{secret}" b'), (2, f"password: '{secret}'")], "doc_id bigint, text string")
    one, two = sorted(surrogates.pseudonymise(docs, key="k").collect(), key=lambda r: r.doc_id)
    new = one.text.removeprefix('a token = "').removesuffix('" b')
    assert len(new) == size and two.text == f"password: '{new}'" and one.pii_types == ["SECRET"]
    assert all(secret[i : i + 8] not in new for i in range(size - 7))
