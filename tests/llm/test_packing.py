import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm.byte_tokens import ByteEncoder
from shelfcast.llm.differencing import differenced, packed
from shelfcast.llm.packing import CAPACITY, pack
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def whole_ids(library, texts):
    return [[*e.ids, 0] for e in library.encode_batch(texts, add_special_tokens=False)]


def check(library, docs, rows, capacity=CAPACITY):
    """Every id of every document once, sequences without gaps; returns the share of padding."""
    texts = [(row["doc_id"], row["text"] or "") for row in docs.select("doc_id", "text").collect()]
    ids = whole_ids(library, [text for _, text in texts])
    wanted = sorted((str(doc_id), one) for (doc_id, _), one in zip(texts, ids))
    pieces = {}
    for row in rows:
        assert row["length"] == len(row["ids"]) > 0
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
        pieces.setdefault((str(row["doc_id"]), row["doc_tokens"]), []).append(row)
    got = []
    for (doc_id, tokens), some in pieces.items():
        some.sort(key=lambda row: row["start"])
        copies = sum(row["length"] for row in some) / tokens
        assert copies == int(copies)
        if copies == 1:
            joined = list(itertools.chain.from_iterable(row["ids"] for row in some))
            assert [row["start"] for row in some] == list(
                itertools.accumulate([0, *[row["length"] for row in some][:-1]])
            )
            got.append((doc_id, joined))
        else:
            got += [one for one in wanted if one[0] == doc_id and len(one[1]) == tokens]
    assert sorted(got) == wanted
    sequences = {}
    for row in rows:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    padding = 0
    for some in sequences.values():
        end = 0
        for offset, length in sorted(some):
            assert offset == end
            end += length
        assert end <= capacity
        padding += capacity - end
    return padding / max(1, padding + sum(map(len, ids)))


def test_documents(spark, library):
    from shelfcast.llm.text import read_documents

    docs = read_documents(spark, "/root/testdata/sf0.01")
    assert check(library, docs, pack(docs, PATH).collect()) < 0.01


def test_many_small_tasks(documents, library):
    rows = pack(documents.repartition(5), PATH).collect()
    assert check(library, documents, rows) < 0.05
    assert len({row["sequence_id"] >> 40 for row in rows}) == 5


@pytest.mark.parametrize("capacity, block, part, slack", [(64, 16, 64, 0), (100, 40, 30, 3), (7, 5, 9, 2)])
def test_other_sizes(documents, library, capacity, block, part, slack):
    rows = pack(documents, PATH, capacity, block=block, part=part, slack=slack).collect()
    check(library, documents, rows, capacity)


def test_odd_rows(odd_docs, no_docs, library):
    check(library, odd_docs, pack(odd_docs.withColumn("start", F.lit("x")), PATH).collect())
    assert pack(no_docs, PATH).count() == 0
    text = odd_docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert dict(pack(text, PATH, with_ids=False).dtypes)["doc_id"] == "string"


def test_reruns_agree(documents):
    first, second = (sorted(map(str, pack(documents, PATH).collect())) for _ in range(2))
    assert first == second


@given(st.text(alphabet=st.sampled_from("ab1 \n\t.,'sdé日　\x85\x1c💥\u200b²٣"), max_size=60))
@settings(max_examples=600, deadline=None)
def test_ids_are_those_of_the_library(text):
    assert [[*ids, 0] for ids in ENCODER.encode([text])] == whole_ids(LIBRARY, [text])


ENCODER, LIBRARY = ByteEncoder(PATH), Tokenizer.from_file(PATH)


def test_every_plain_character():
    """Each character that the faster library may see, alone and among letters and blanks."""
    plain = [chr(code) for code in range(0x10000) if not 0xD800 <= code < 0xE000 and ENCODER.plain(chr(code))]
    assert len(plain) > 20_000
    texts = [f"a{c}1 {c}b  {c}{c}\n{c}." for c in plain]
    assert [[*ids, 0] for ids in ENCODER.encode(texts)] == whole_ids(LIBRARY, texts)


def test_odd_texts_and_special_strings():
    texts = [text or "" for text in ODD_TEXTS]
    texts += ["a <|endoftext|> b", "x<|endoftext|>y <|endoftext|>", " lead", "trail ", "a  b", "x" * 999]
    assert [[*ids, 0] for ids in ENCODER.encode(texts)] == whole_ids(LIBRARY, texts)
    assert not ENCODER.plain("<|endoftext|>") and ENCODER.plain("it's plain")


def test_differencing_is_better_than_any_order():
    """Against every split of small sets: the known worst case of differencing is 7 / 6."""
    random = np.random.default_rng(3)
    for _ in range(30):
        sizes = random.integers(1, 60, 8)
        best = min(
            max(sizes[list(side)].sum(), sizes.sum() - sizes[list(side)].sum())
            for many in range(9)
            for side in itertools.combinations(range(8), many)
        )
        window = differenced(sizes, 2)
        assert np.bincount(window, sizes, minlength=2).max() <= 7 / 6 * best + 1


def test_near_equal_windows():
    sizes = np.random.default_rng(4).integers(1, 513, 512)
    window = differenced(sizes, 128)
    sums = np.bincount(window, sizes, minlength=128)
    assert sums.max() - sums.min() < 40 and sums.sum() == sizes.sum()


def test_count_rises():
    window, windows = packed(np.array([6, 6, 6]), 10)
    assert windows == 3 and sorted(window.tolist()) == [0, 1, 2]
    assert packed(np.array([5, 5]), 10)[1] == 1 and packed(np.array([10] * 4), 10)[1] == 4
