import io
import os
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from eventide.llm import records, warc
from eventide.llm.queries import tokenizer_path
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = tokenizer_path()
FULL = Tokenizer.from_file(PATH)
ENCODER = records.WordEncoder(PATH)


def plain_ids(text):
    return FULL.encode(text or "", add_special_tokens=False).ids


TEXTS = st.lists(st.one_of(
    st.text(), st.text(alphabet="aéÀÖßñ'’.,;#*$%&|()s \t\n\x0b\x1c\x85\xa0İΣσ́"),
    st.sampled_from(["don't", "The THE the.", "<|endoftext|>", "x<|startoftext|>y", "ﬁ №5", "1 22 333"])), max_size=6)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_word_encoder_equals_whole_text_encoding(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, ends = ENCODER.encode(pa.array(texts, pa.string()))
    start = 0
    for text, end in zip(texts, ends.tolist()):
        assert ids[start:end].tolist() == plain_ids(text)
        start = end


def test_records_round_trip(spark, odd_docs, no_docs):
    got = records.encode_documents(spark, odd_docs, PATH, end_id=2).orderBy("start").collect()
    want = odd_docs.select("doc_id", "text").collect()
    assert len(got) == len(want)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in want), key=lambda v: (v is not None, v or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    expected = sorted((r.doc_id is not None, r.doc_id or 0, zlib.crc32(np.array(plain_ids(r.text) + [2], "<u4").tobytes()))
                      for r in want)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32) for r in got) == expected
    assert records.encode_documents(spark, no_docs, PATH, end_id=2).count() == 0


def test_index_reads_single_records(spark):
    folder = tempfile.mkdtemp(prefix="records-", dir="/tmp")
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id bigint, text string")
    files = records.write_records(docs, folder, PATH, end_id=2, files=3)
    assert sum(n for _, n, _ in files) == 50
    for part, n, _ in files:
        index = records.read_index(folder, part)
        order = np.random.default_rng(0).permutation(n)
        for e, (doc, ids) in zip(index[order], records.read_at(folder, part, index[order])):
            assert doc == e["doc_id"] and ids.tolist() == plain_ids(f"text number {doc}") + [2]


def test_damaged_record_is_noticed(spark):
    folder = tempfile.mkdtemp(prefix="records-", dir="/tmp")
    docs = spark.createDataFrame([(i, "some text") for i in range(5)], "doc_id bigint, text string")
    (part, _, _), = records.write_records(docs, folder, PATH, end_id=2, files=1)
    path = f"{folder}/part-{part:06d}.rec"
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(ValueError):
        list(records._frames(io.BytesIO(bytes(data))))


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def salvage(data):
    return list(warc.salvage(Bytes(data), len(data)))


def archive(n, compress=True, size=3000):
    rng = np.random.default_rng(n)
    out = [warc.build_record(i, f"http://h/{i}", bytes(rng.integers(0, 256, size + i, dtype=np.uint8))) for i in range(n)]
    return [warc.gzip_member(r) for r in out] if compress else out


@pytest.mark.parametrize("compress", [True, False])
def test_clean_archive_has_no_gaps(compress):
    parts = archive(6, compress)
    got = salvage(b"".join(parts))
    assert [warc.page_of(r.headers["warc-record-id"]) for r in got] == list(range(6))
    assert [r.length for r in got] == [len(p) for p in parts]


@pytest.mark.parametrize("compress", [True, False])
def test_damage_costs_only_the_records_it_touches(compress):
    parts = archive(8, compress)
    for hurt in range(8):
        for place in (0, 3, len(parts[hurt]) // 2, len(parts[hurt]) - 1):
            data = [bytearray(p) for p in parts]
            data[hurt][place] ^= 0x55
            got = salvage(bytes(b"".join(data)))
            records_ = [warc.page_of(r.headers["warc-record-id"]) for r in got if isinstance(r, warc.Record)]
            gaps = [g for g in got if isinstance(g, warc.Gap)]
            assert set(range(8)) - {hurt} <= set(records_)
            if hurt not in records_:  # an unused gzip header byte may change without harm
                start = sum(map(len, parts[:hurt]))
                assert [(g.offset, g.length) for g in gaps] == [(start, len(parts[hurt]))]


def test_garbage_truncation_and_wrong_digest():
    parts = archive(3)
    data = b"garbage" + parts[0] + b"\x1f\x8b\x08junk" + parts[1] + parts[2][:-50]
    got = salvage(data)
    kinds = [type(x).__name__ for x in got]
    assert kinds == ["Gap", "Record", "Gap", "Record", "Gap"]
    assert sum(x.length for x in got) == len(data)
    bad = warc.build_record(1, None, b"payload").replace(b"\r\n\r\npayload", b"\r\n\r\npayl0ad")
    assert [type(x).__name__ for x in salvage(warc.gzip_member(bad) + parts[0])] == ["Gap", "Record"]


def test_magic_across_window_border():
    parts = archive(2, size=100)
    for shift in range(-4, 5):
        data = b"z" * (warc.WINDOW + shift) + parts[0] + parts[1]
        assert [type(x).__name__ for x in salvage(data)] == ["Gap", "Record", "Record"]


def test_round_trip_with_copies_nulls_and_gaps(spark):
    pages = spark.createDataFrame(
        [(1, "u1", "same"), (5, "u5", "same"), (3, None, "same"), (None, "u", "same"), (7, "a\nb", None), (8, "b", ""),
         (9, "c", "é\U0001f600"), (9, "c", "é\U0001f600"), (None, None, "alone")],
        "page_id bigint, url string, html string")
    got = warc.round_trip(spark, pages).collect()
    assert all(r.gap is None for r in got) and len(got) == 9
    seen = sorted((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in got)
    assert seen == sorted([(False, 1, "revisit", 5, 4), (False, 5, "response", 0, 4), (False, 3, "revisit", 5, 4),
                           (True, 0, "revisit", 5, 4), (False, 7, "revisit", 8, 0), (False, 8, "response", 0, 0),
                           (False, 9, "response", 0, 6), (False, 9, "response", 0, 6), (True, 0, "response", 0, 5)])
    assert {r.payload_digest for r in got if r.payload_bytes == 4} == {warc.sha1_base32(b"same")}
    large = warc.round_trip(spark, pages, min_bytes=5).where("record_type = 'revisit'").count()
    assert large == 0
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_spark_reader_reports_gaps(spark):
    folder = tempfile.mkdtemp(prefix="warc-", dir="/tmp")
    parts = archive(5)
    parts[2] = parts[2][:100] + b"\0" * 50 + parts[2][150:]
    with open(os.path.join(folder, "x.warc.gz"), "wb") as f:
        f.write(b"".join(parts))
    got = warc.read_archives(spark, folder, ["x.warc.gz"], payloads=True).orderBy("offset").collect()
    assert [r.page_id for r in got] == [0, 1, None, 3, 4] and got[2].gap and got[2].length == len(parts[2])
    assert len(got[4].payload) == 3004
