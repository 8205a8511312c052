import io
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickloom.llm import binary, files
from samples import TOKENIZER


@pytest.mark.parametrize("width", [1, 3, 8, 11, 16, 17, 31, 32])
def test_bits_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1000, dtype=np.uint64).astype(np.uint32)
    raw = binary.pack_bits(ids, width)
    assert len(raw) == -(-1000 * width // 8) and (binary.unpack_bits(raw, 1000, width) == ids).all()


class Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_random_access_reads_any_range():
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 5000, n).astype(np.uint32) for n in (1, 0, 130, 7, 64, 300)]
    out = io.BytesIO()
    writer = binary.TokenWriter(out, 13, block_ids=64)
    writer.add([5, None, 7], np.concatenate(texts[:3]), np.cumsum([1, 0, 130]))
    writer.add([8, 9, 9], np.concatenate(texts[3:]), np.cumsum([7, 64, 300]))
    writer.close()
    file = binary.TokenFile(Memory(out.getvalue()))
    whole = np.concatenate(texts)
    assert file.doc_ids[file.known].tolist() == [5, 7, 8, 9, 9] and file.n_ids == len(whole)
    for i, text in enumerate(texts):
        assert (file.document(i) == text).all()
    for a, b in draw.integers(0, len(whole) + 1, (50, 2)):
        assert (file.ids(a, b) == whole[a:b]).all()
    with pytest.raises(ValueError, match="bits"):
        writer.add([1], np.array([1 << 13], dtype=np.uint32), np.array([1]))


def test_messy_rows_equal_direct_encoding(docs, empty):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    folder = files.new_folder(docs.sparkSession, "tokens")
    written = binary.write_tokens(docs.repartition(3), folder, TOKENIZER, 50_257)
    got = binary.read_tokens(written).collect()
    expected = []
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        expected.append((r[0], len(ids), zlib.crc32(ids.tobytes())))
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=str) == sorted(expected, key=str)
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in got], key=lambda d: (d is not None, d or 0))
    with files.open_random(written.first().path) as raw:
        assert binary.TokenFile(raw).width == 16
    assert binary.round_trip(empty, TOKENIZER, 50_257).count() == 0
