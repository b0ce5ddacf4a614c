import zlib

import numpy as np
import public_tokenizers
import pytest

from tenura.llm import pfor, token_files
from tenura.llm.pieces import load_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("most", [1, 2, 50_257, 2**32])
def test_blocks_round_trip(n, most):
    random = np.random.default_rng(n)
    ids = random.integers(0, most, n, dtype=np.uint64).astype(np.uint32)
    ids[::37] = most - 1
    data, starts = pfor.pack(ids)
    assert len(starts) == -(-n // pfor.BLOCK)
    assert (pfor.unpack(data, starts) == ids).all()


def test_outliers_are_exceptions():
    ids = np.arange(256, dtype=np.uint32) % 16
    ids[[3, 200]] = 2**31
    data, starts = pfor.pack(ids)
    head = np.frombuffer(data[: pfor.HEAD.itemsize], pfor.HEAD)[0]
    assert (head["width"], head["patches"]) == (4, 2)
    assert (pfor.unpack(data, starts) == ids).all()


def test_files_round_trip(spark, rows, tmp_path):
    texts = ["", None, "one two", "a  b\n\nc <|endoftext|> d", "word " * 3000, "one two", "é中\t x"]
    data = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(5, "again", "clash", 1), (None, "no id", "clash", 1)]
    docs = rows("doc_id long, text string, key string, ids_crc32 int", data)
    manifest = token_files.write_token_files(docs, PATH, 2, folder=str(tmp_path / "ids"), file_ids=500)
    got = [tuple(r) for r in token_files.read_token_files(manifest).collect()]
    tokenizer = load_tokenizer(PATH)
    expected, start = [], 0
    for d, t, *_ in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        expected.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected
    assert manifest.count() > 1


def test_a_task_that_runs_again_leaves_the_manifest_right(spark, rows, tmp_path):
    docs = rows("doc_id long, text string", [(1, "a b"), (2, "c")])
    first = token_files.write_token_files(docs, PATH, 2, folder=str(tmp_path / "ids"))
    token_files.write_token_files(docs, PATH, 2, folder=str(tmp_path / "ids"))
    assert token_files.read_token_files(first).count() == 2


def test_empty_table(spark, rows):
    manifest = token_files.write_token_files(rows("doc_id long, text string", []), PATH, 2)
    assert manifest.count() == 0
    assert token_files.read_token_files(manifest).count() == 0


def test_incomplete_file_is_refused(tmp_path):
    (tmp_path / "x.tpf").write_bytes(b"0" * 100)
    with pytest.raises(ValueError):
        next(token_files.read_documents(f"file://{tmp_path}/x.tpf"))
