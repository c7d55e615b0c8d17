import glob
import io
import os
import random
import struct
import zlib

import numpy as np
import pytest
import zstandard

import __spark_entry__ as registry
from replyloom.llm import tokenfiles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")
PATH = vocabularies.path("word_bpe_49k.json")
ENCODING = tokenfiles.Encoding(PATH, end_id=2, folds=True)


@pytest.fixture(scope="module")
def reference():
    model = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: [*model.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("folds", [False, True])
def test_words_are_encoded_as_in_the_whole_text(reference, odd_texts, folds):
    encoder = tokenfiles.Encoding(PATH, 2, folds=folds).open()
    tricky = [
        "I'll can't 'S  x's y　z \x1c a\x0bb\x0cc", "<|endoftext|> a<|startoftext|>b", "é ́ öne ΑΣ Σ ΣΑΣ",
        "12345 a1b2 ...!? <p>", "ﬁ \U0001f600‍ x y", "à\ńb", "\x00 \x00a",
        "It's. 's, a.b... c!?d 'S,'s;'re: A.B.C. <|ENDOFTEXT|>", "x<|endoftext|>. Y, Z", "É, é. à; K. İ! ſ,",
        " ".join(map(chr, range(33, 0x180))), "".join(map(chr, range(0xDF, 0x100))), "ærø, ß: ªº aªb. naïveté...",
    ]
    for text in [*odd_texts, *tricky]:
        found = np.frombuffer(b"".join(encoder((text or "").encode())), f"<u{encoder.width}").tolist()
        assert found == reference(text)


def test_blocks_cut_at_white_space_only():
    text = " ".join(str(i) for i in range(5000)).encode() + b" " + b"x" * 3000 + b"\ty"
    parts = list(tokenfiles.blocks(text, 1000))
    assert len(parts) > 20 and [w for p in parts for w in p.split()] == text.split()
    assert list(tokenfiles.blocks(b"")) == [b""]


def written(documents, width=2, frame_ids=100):
    out = io.BytesIO()
    file = tokenfiles.TokenFileWriter(out, width, frame_ids)
    for key, ids in documents:
        data = np.array(ids, f"<u{width}").tobytes()
        file.add(key, [data[:6], data[6:]])
    file.close()
    return out.getvalue()


def some_documents(seed=3):
    r = random.Random(seed)
    return [(None if i == 0 else i * 3, [r.randrange(60_000) for _ in range(r.choice([0, 1, 7, 99, 100, 101, 950]))]) for i in range(60)]


@pytest.mark.parametrize("width", [2, 4])
def test_file_gives_back_any_document(width):
    documents = some_documents()
    file = tokenfiles.TokenFile(io.BytesIO(written(documents, width)))
    index = list(file.index())
    assert [k for k, _, _ in index] == [k for k, _ in documents]
    for i in (0, 5, 17, 59, 30):
        _, first, n = index[i]
        before = file.frames_read
        assert next(file.read([(first, n)])).tolist() == documents[i][1]
        assert file.frames_read - before <= n // 100 + 2
    whole = list(file.read((first, n) for _, first, n in index))
    assert [w.tolist() for w in whole] == [ids for _, ids in documents]


def test_plain_decoder_reads_the_ids():
    documents = some_documents()
    ids = [x for _, d in documents for x in d]
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(written(documents)), read_across_frames=True)
    assert np.frombuffer(stream.read()[: 2 * len(ids)], "<u2").tolist() == ids


def test_damage_is_found():
    data = bytearray(written(some_documents()))
    data[40] ^= 1
    file = tokenfiles.TokenFile(io.BytesIO(bytes(data)))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        file.frame(0)
    table = bytearray(written(some_documents()))
    frames = struct.unpack("<I", table[-9:-5])[0]
    table[-9 - 12 * frames + 8] ^= 1  # the checksum of the first frame
    with pytest.raises(ValueError, match="checksum"):
        tokenfiles.TokenFile(io.BytesIO(bytes(table))).frame(0)
    with pytest.raises(ValueError, match="seek table"):
        tokenfiles.TokenFile(io.BytesIO(bytes(table[:-1]) + b"x"))


def expected(rows, reference):
    start, found = 0, []
    for key, text in rows:
        ids = reference(text)
        found.append((key, start, len(ids), struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    return found


def flat(found):
    rows = sorted(found.collect(), key=lambda r: r.start)
    return [(r.key, r.start, r.n, bytes(r.ids)) for r in rows]


def test_round_trip_over_many_files(spark, documents, odd_texts, prose, reference, tmp_path):
    texts = [*odd_texts, *(prose(i, 40 + 13 * i) for i in range(40))]
    docs = documents(texts).repartition(3)
    folder = str(tmp_path / "t")
    locations = tokenfiles.write(docs, folder, ENCODING, file_ids=3000, frame_ids=256, task_bytes=20_000)
    assert locations.count() == len(texts) and len(glob.glob(f"{folder}/*.zst")) > 5
    assert not glob.glob(f"{folder}/.tokens*")
    want = expected(enumerate(texts), reference)
    assert flat(tokenfiles.read(spark, folder)) == want
    wanted = documents([(i, "", "") for i in (45, 3, 6, 3, 999)])
    assert flat(tokenfiles.fetch(folder, wanted)) == [w for w in want if w[0] in (3, 6, 45)]


def test_same_files_on_every_run(spark, documents, prose, tmp_path):
    rows = [(i % 20, prose(i % 15, 60), "s") for i in range(80)]
    contents = []
    for run in range(2):
        folder = str(tmp_path / f"r{run}")
        tokenfiles.write(documents(rows).repartition(run + 2), folder, ENCODING, file_ids=500, task_bytes=1 << 30)
        contents.append({f.rsplit("/", 1)[1]: open(f, "rb").read() for f in glob.glob(f"{folder}/*.zst")})
    assert contents[0] == contents[1] and len(contents[0]) > 2


def test_null_and_repeated_keys_and_empty_table(spark, documents, reference, tmp_path):
    rows = [(7, "b", "x"), (None, None, "x"), (7, "b", "x"), (None, "z", "x"), (1, "a", "x")]
    found = flat(tokenfiles.round_trip(documents(rows), ENCODING))
    assert [f[0] for f in found] == [None, None, 1, 7, 7] and found[3][2:] == found[4][2:]
    assert sorted(f[2] for f in found[:2]) == [1, 2]
    assert flat(tokenfiles.round_trip(documents([]), ENCODING)) == []


def test_whole_texts_for_tokenizers_that_keep_spaces(spark, documents):
    path = vocabularies.path("byte_bpe_50k.json")
    model = tokenizers.Tokenizer.from_file(path)
    texts = ["a b  c", None, " lead", "x\n\ny"]
    found = flat(tokenfiles.round_trip(documents(texts), tokenfiles.Encoding(path, 50256, by_word=False)))
    ids = [[*model.encode(t or "", add_special_tokens=False).ids, 50256] for t in texts]
    assert [f[3] for f in found] == [struct.pack(f"<{len(i)}I", *i) for i in ids]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_query_against_the_tokenizer(spark, reference):
    found = registry.queries()["op13_token_files"](spark, SF_DIR).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want = [(k, s, n, zlib.crc32(b)) for k, s, n, b in expected(docs, reference)]
    assert [tuple(r) for r in found] == want
