import random

import pytest

from passages.operators.chunking import char_window_chunks, token_window_chunks, word_chunks
from passages.plans.catalog import QUERIES
from passages.session import scratch_path


def _texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _by_doc(rows):
    found = {}
    for row in sorted(rows, key=lambda r: (r.doc_id, r.chunk_no)):
        assert row.chunk_no == len(found.setdefault(row.doc_id, []))
        found[row.doc_id].append(row.text)
    return found


@pytest.mark.parametrize("size,overlap", [(300, 80), (7, 3), (5, 0), (4, 3), (1, 0)])
def test_word_windows(spark, size, overlap):
    lengths = [0, 1, size - 1, size, size + 1, 2 * size - overlap, 2 * size, 3 * size + 2, 907]
    words = [[f"w{i}" for i in range(n)] for n in lengths]
    found = _by_doc(word_chunks(_texts(spark, [" ".join(w) for w in words]),
                                chunk_size=size, overlap=overlap).collect())
    for doc, w in enumerate(words):
        starts = [s for s in range(0, len(w), size - overlap) if s == 0 or s + overlap < len(w)]
        assert found.get(doc, []) == [" ".join(w[s:s + size]) for s in starts]


def test_words_split_at_unicode_space(spark):
    text = "　a b c\r\n\td\u0085e  f​g "
    assert word_chunks(_texts(spark, [text])).collect()[0].text == "a b c d e f​g"


@pytest.mark.parametrize("overlap", [300, 301, -1])
def test_overlap_is_checked(spark, overlap):
    for cut in (word_chunks, char_window_chunks):
        with pytest.raises(ValueError):
            cut(_texts(spark, ["a"]), "doc_id", "text", 300, overlap)


@pytest.mark.parametrize("size,overlap", [(400, 80), (6, 2), (5, 0), (1, 0)])
@pytest.mark.parametrize("keep_tail", [False, True])
def test_char_windows(spark, size, overlap, keep_tail):
    rng = random.Random(size)
    alphabet = "ab \né中\U0001f600"
    lengths = [0, 1, size - 1, size, size + 1, 2 * size - overlap, 2 * size - overlap - 1, 1033]
    texts = ["".join(rng.choice(alphabet) for _ in range(n)) for n in lengths]
    found = _by_doc(char_window_chunks(_texts(spark, texts), size=size, overlap=overlap,
                                       keep_tail=keep_tail).collect())
    stride = size - overlap
    for doc, text in enumerate(texts):
        starts = [s for s in range(0, len(text), stride) if s + size <= len(text)]
        if keep_tail and text and (not starts or starts[-1] + size < len(text)):
            starts.append(len(starts) * stride)
        assert found.get(doc, []) == [text[s:s + size] for s in starts]


def test_char_windows_of_the_query_run_over_non_empty_lines(spark):
    lines = [f"line {i} " + "x" * 40 for i in range(40)]
    folder = scratch_path(spark, "blank-lines")
    _texts(spark, ["\r\n\n".join(lines) + "\n\n"]).write.parquet(f"{folder}/documents.parquet")
    text = "\n".join(lines)
    assert _by_doc(QUERIES["char_window_chunks"](spark, folder).collect()) == {
        0: [text[s:s + 400] for s in range(0, len(text) - 399, 320)]}


@pytest.mark.parametrize("size,overlap,pad", [(510, 100, 512), (4, 1, 9), (3, 0, 5)])
def test_token_windows(spark, size, overlap, pad):
    lists = [list(range(1000, 1000 + n)) for n in (0, 1, size, size + 1, 2 * size, 1300)]
    rows = token_window_chunks(
        spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>"),
        chunk_size=size, overlap=overlap, pad_to=pad,
    ).collect()
    expected = []
    for doc, ids in enumerate(lists):
        for no, start in enumerate(range(0, len(ids), size - overlap)):
            real = [101, *ids[start:start + size], 102]
            fill = [0] * (pad - len(real))
            expected.append((doc, no, real + fill, [1] * len(real) + fill))
    assert sorted(map(tuple, rows)) == expected


def test_token_window_must_fit(spark):
    ids = spark.createDataFrame([(1, [1])], "doc_id long, ids array<int>")
    with pytest.raises(ValueError):
        token_window_chunks(ids, chunk_size=511, pad_to=512)
