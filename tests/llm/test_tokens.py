import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsloom.llm import bpe, id_files, registry
from tests.llm.cases import ODD_TEXTS, documents, save

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def rows_of(spark, folder):
    return sorted(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    save(documents(spark, [*ODD_TEXTS, *ODD_TEXTS]), folder, "documents")
    return folder


@pytest.mark.parametrize("where", [SF, "odd"])
def test_bpe_equals_the_library(spark, library, odd, where):
    folder = odd if where == "odd" else where
    got = {r.doc_id: tuple(r)[1:] for r in registry.op4_bpe(spark, folder).collect()}
    assert got == {r.doc_id: expected(library, r.text) for r in rows_of(spark, folder)}


@pytest.mark.parametrize("where", [SF, "odd"])
def test_id_files_read_back(spark, library, odd, where):
    folder, start = odd if where == "odd" else where, 0
    got = sorted(tuple(r) for r in registry.op2_id_files(spark, folder).collect())
    for row, (doc_id, text) in zip(got, rows_of(spark, folder), strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert row == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_ids_and_texts_come_back(spark, library):
    rows = bpe.encode(documents(spark, ODD_TEXTS), PATH, digests=False).collect()
    for r in rows:
        assert r.ids == library.encode(ODD_TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)


def test_cut_pieces_encode_as_the_whole(library):
    import pyarrow as pa

    rng, encoder = random.Random(3), bpe.RankArrayBpe(bpe.read_vocabulary(PATH))
    letters = "aZé'.,!<|>9 \n\t#é́ΣİA世٣sTlL"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(25))) for _ in range(1500)]
    texts += [t.replace("<", "<|endoftext|>") for t in texts[:300]]
    pieces, which, rows = bpe.pieces_of(pa.array(texts))
    coded = encoder.encode_pieces(pieces)
    for i, text in enumerate(texts):
        assert [t for p in which[rows[i] : rows[i + 1]] for t in coded[p]] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [0, 1, 5, 70000])
@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes_come_back(size, planes):
    ids = np.random.default_rng(1).integers(0, 2**32, size, dtype=np.uint32)
    payload, sizes = id_files.pack(ids, planes)
    assert (id_files.unpack(payload, sizes, size, planes) == ids).all()


def test_bit_planes_through_files(spark, tmp_path):
    target = str(tmp_path / "ids")
    id_files.write_ids(documents(spark, ODD_TEXTS), PATH, target, planes="bit", partitions=3)
    rows = id_files.read_documents(spark, target, planes="bit").collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(ODD_TEXTS)))
    chunks = id_files.read_ids(spark, target, planes="bit").collect()
    assert sum(len(c.ids) for c in chunks) == sum(r.n_tokens for r in rows)


def test_empty_table(spark, tmp_path):
    save(documents(spark, []), tmp_path, "documents")
    assert registry.op2_id_files(spark, str(tmp_path)).collect() == []
    assert registry.op4_bpe(spark, str(tmp_path)).collect() == []
