"""Archives, the pipeline's stages, and the registered queries against their SQL."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import random
import zipfile

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import compare, connect
from stagewise.llm import warc
from stagewise.llm.registry import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# --- archives ---


class _File(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def _zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data, zipfile.ZIP_DEFLATED if name == "packed" else zipfile.ZIP_STORED)
        z.comment = b"a comment of some length, which moves the end record away from the end"
    return _File(out.getvalue())


def test_members_are_those_that_zipfile_lists(monkeypatch):
    files = {"one": b"1" * 70, "packed": b"2" * 900, "empty": b"", "é": b"three"}
    plain = _zipped(**files)
    # Every size and offset beyond 20 now needs the ZIP64 fields, and so does the directory.
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 20)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    for file in (plain, _zipped(**files)):
        with zipfile.ZipFile(file) as z:
            want = [(i.filename, i.compress_type, i.compress_size, i.file_size, i.header_offset) for i in z.infolist()]
        members = warc.zip_members(file)
        assert [(m.name, m.method, m.packed, m.size, m.header) for m in members] == want
        for m in members:
            if not m.method:
                assert warc._read_at(file, warc.member_start(file, m), m.size) == files[m.name]
    with pytest.raises(ValueError):
        warc.zip_members(_File(b"no archive at all, only some bytes"))


def test_pages_come_back_as_written(spark, path):
    big, bytes_1000, umlaut = "<p>" + "x" * 2000, "y" * 1000, "ü" * 600
    pages = [(1, "http://a/", big), (2, "http://b/\r\nX: y é", big), (3, None, "small"), (4, "u", "small"), (5, "u", None)]
    pages += [(6, "u", ""), (7, "u", bytes_1000), (8, "u", bytes_1000), (9, "u", bytes_1000[:-1]), (10, "u", bytes_1000[:-1])]
    pages += [(11, "u", umlaut), (12, "u", umlaut), (12, "u", umlaut), (None, "u", big), (None, "u", "z" * 3000), (None, "u", "z" * 3000)]
    pages += [(100 + i, "u", f"{i}\r\n\r\n" * 500) for i in range(30)] + [(200, "u", "long " * 400_000)]
    table = spark.createDataFrame([(*p, "no", 1) for p in pages], "page_id long, url string, html string, digest string, of int")
    archives = warc.write_archives(table.repartition(3), f"{path}/archives", archive_bytes=1_500)
    assert archives.count() > 3 and archives.agg({"records": "sum"}).first()[0] == len(pages)
    top = {}
    for page, _, html in pages:
        if page is not None and len((html or "").encode()) >= 1000:
            top[html] = max(page, top.get(html, page))
    want = []
    for page, _, html in pages:
        raw, first = (html or "").encode(), top.get(html)
        again = first is not None and page != first
        want.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", first if again else None, None if again else raw))
    found = warc.read_archives(archives, span_bytes=600).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    key = lambda row: str((row[0], row[2], row[3]))
    assert sorted((tuple(r)[:5] + (None if r[5] is None else bytes(r[5]),) for r in found.collect()), key=key) == sorted(want, key=key)
    for name in os.listdir(f"{path}/archives"):
        if name.endswith(".wacz"):
            with zipfile.ZipFile(f"{path}/archives/{name}") as z:
                assert z.testzip() is None and warc.DATA in z.namelist()
    none = warc.write_archives(table.where("page_id < 0"), f"{path}/none")
    assert warc.read_archives(none).count() == 0


def _foreign(path, pages, shuffled):
    """An archive as another writer makes it: two data members, a packed index sorted by address, other record kinds."""
    lines, data = [], {"one.warc.gz": b"", "two.warc.gz": b""}
    for n, (url, body) in enumerate(pages):
        name = sorted(data)[n % 2]
        for kind, block in (("request", b"GET / HTTP/1.1\r\n\r\n"), ("response", b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n" + body)):
            head = f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Target-URI:{url}\r\nContent-Length: {len(block)}\r\n\r\n"
            record = gzip.compress(head.encode() + block + b"\r\n\r\n")
            place = {"offset": len(data[name]), "length": len(record), "filename": f"archive/{name}"}
            lines.append(f"{url} 2024 {json.dumps(place)}")
            data[name] += record
    shuffled.shuffle(lines)
    index = gzip.compress("\n".join(["!meta", *lines[:3]]).encode()) + gzip.compress(("\n" + "\n".join(lines[3:])).encode())
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for name, raw in {**{f"archive/{n}": d for n, d in data.items()}, "indexes/index.cdx.gz": index, "pages/pages.jsonl": b"{}"}.items():
            z.writestr(name, raw)


def test_archives_of_other_writers_are_read(spark, path):
    pages = [(f"http://site/{n}", f"<p>{n}</p>".encode() * (n + 1)) for n in range(20)]
    _foreign(f"{path}/other.wacz", pages, random.Random(2))
    archives = spark.createDataFrame([(f"{path}/other.wacz",)], "path string")
    found = warc.read_archives(archives, span_bytes=500).collect()
    got = sorted((r["url"], bytes(r["payload"]), r["payload_digest"]) for r in found if r["record_type"] == "response")
    assert got == sorted((u, b, hashlib.sha1(b).hexdigest()) for u, b in pages)
    assert sum(r["record_type"] == "request" and r["payload"] is None for r in found) == 20
    with zipfile.ZipFile(f"{path}/bare.wacz", "w") as z:
        z.writestr("archive/one.warc.gz", b"")
    with pytest.raises(Exception, match="no index below"):
        warc.read_archives(spark.createDataFrame([(f"{path}/bare.wacz",)], "path string")).collect()


def test_reading_back_is_dealt_out_by_the_bytes_of_the_archives(spark, path, monkeypatch):
    pages = spark.createDataFrame([(n, "u", f"{n} " * 3000) for n in range(60)], "page_id long, url string, html string")
    archives = warc.write_archives(pages.coalesce(1), f"{path}/a", archive_bytes=2_000)
    monkeypatch.setattr(warc, "TASK_BYTES", 100)
    size = archives.agg({"bytes": "sum"}).first()[0]
    assert warc.read_archives(archives).rdd.getNumPartitions() == -(-size // 100) > 8


# --- the pipeline ---


def _documents(spark, path):
    base = [f"Word{i} and part{i * 7 % 13}" for i in range(60)]
    texts = {1: "\n".join(base), 2: "\n".join(base[:40] + ["a line of its own"] + base[40:]), 3: "short text", 4: ""}
    texts |= {5: " ".join(f"u{i}" for i in range(200)), 6: " ".join(f"u{i}" for i in range(200)) + " tail", 7: None}
    texts |= {8: "before " + " ".join(f"Bench{i}" for i in range(12)) + " after", 9: "Ünïque; text 4 you"}
    for d in range(20, 220):
        texts[d] = f"document number {d} says grobian things" if d % 5 == 0 else f"document number {d} is clean and has {d} words"
    rows = [(d, t, "en", "s", len(t or "")) for d, t in texts.items()] + [(None, "without an id", "en", "s", 13)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d, 1, int(d % 5 == 0)) for d in range(20, 220)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"bench{i}" for i in range(12))), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return {d: t for d, t, *_ in rows}


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_every_stage_does_what_plain_python_does(spark, path):
    texts = _documents(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "bpe"]
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, path)
    assert clean.columns == docs.columns
    assert _texts(clean) == {d: t for d, t in texts.items() if d is None or d < 20 or d % 5}
    # From here on each stage runs on all documents, toxic ones too: it is judged on its own input.
    cut = stages["line_dedup"](spark, docs, path)
    want = {d: t for d, (_, _, t) in brute.line_dedup({d: t for d, t in texts.items() if d is not None}).items()}
    assert cut.columns == docs.columns and _texts(cut) == want | {None: texts[None]}
    assert all(r["n_chars"] == len(r["text"] or "") for r in cut.collect())
    first = stages["jaccard_join"](spark, docs, path)
    found = brute.jaccard_components({d: t for d, t in texts.items() if d is not None}, 5, 80)
    assert first.columns == docs.columns
    assert _texts(first) == {d: t for d, t in texts.items() if d is None or found[d][1] == d}
    apart = stages["decontamination"](spark, docs, path)
    assert apart.columns == docs.columns and _texts(apart) == {d: t for d, t in texts.items() if d != 8}
    ends = corpus_pipeline.run(spark, path).collect()
    chain = brute.line_dedup({d: t for d, t in texts.items() if d is not None and (d < 20 or d % 5)})
    chain = {d: t for d, (_, _, t) in chain.items()}
    found = brute.jaccard_components(chain, 5, 80)
    assert {r["doc_id"] for r in ends} == {d for d in chain if found[d][1] == d and d != 8} | {None}
    assert all(r["n_tokens"] == len(r["ids"]) and "text" not in r for r in ends)


def test_stages_keep_columns_whatever_their_names(spark, path):
    _documents(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = "row row_ key runs whole_text cut_lines __key __text _row component_id rank node row_number spans items n_words score ids n_tokens decoded".split()
    more = docs.withColumns({n: F.lit(f"own {n}") for n in names})
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, more, path)
        if name != "bpe":
            assert made.columns == more.columns
            assert all(made.where(F.col(n) != f"own {n}").isEmpty() for n in names) and not made.isEmpty()
        else:
            assert len(set(made.columns)) == len(made.columns) and dict(made.dtypes)["n_tokens"] == "bigint"


def test_empty_documents_pass_every_stage(spark, path):
    _documents(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.count() == 0


# --- registered queries ---


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_against_its_sql(spark, con, key):
    assert compare(QUERIES[key](spark, SF_DIR), con, ORACLE[key]) == ""


def test_all_are_registered():
    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert {n.split("_")[0] for n in QUERIES if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
