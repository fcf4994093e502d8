"""Long texts without a space, thousands of labels, unclosed tags: each operator stays linear."""

import gzip
import time

import pytest

from starmill.llm import middle, pseudonyms, secrets, simhash, toxicity, warc

RUNS = {
    "letters": "a" * 1_000_000,
    "base64": "aZ09+/" * 160_000,
    "dots": "." * 30_000,
    "labels": "x@a" + ".a" * 30_000,
    "dotted": "a1." * 100_000,
    "cards": "4111111111111111 " * 20_000,
    "links": "<a " * 30_000,
    "titles": "<title>" * 30_000,
    "hrefs": "<a href" * 30_000,
    "quotes": "<a href=\"'" * 30_000,
    "lines": ("A" * 60 + "\n") * 16_000,
}


def taken(work, *given):
    began = time.perf_counter()
    work(*given)
    return time.perf_counter() - began


@pytest.mark.parametrize("name", sorted(RUNS))
def test_secrets_are_linear(name):
    assert taken(secrets.confirmed_spans, RUNS[name]) + taken(secrets.base_spans, RUNS[name]) < 4


@pytest.mark.parametrize("name", sorted(RUNS))
def test_derived_records_are_linear(name):
    headers, block = warc.Headers(["WARC-Type: response"]), b"HTTP/1.1 200 OK\r\n\r\n" + RUNS[name].encode()
    assert taken(lambda: list(warc.derived(headers, block))) < 4


@pytest.mark.parametrize("name", sorted(RUNS))
def test_fingerprints_and_cuts_are_linear(name):
    assert taken(simhash.fingerprint, RUNS[name]) < 4
    assert taken(middle.cut, RUNS[name].encode(), 12345, 678) < 1
    assert taken(toxicity._hits, RUNS[name], None) < 4


def test_pseudonyms_of_long_runs(spark):
    texts = [*RUNS.values(), "n" * 70 + "@example.com", "jo@example" + ".co" * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pseudonyms.pseudonymise(docs).collect()}
    changed = {name: rows[i].text != text for i, (name, text) in enumerate(RUNS.items())}
    assert {n for n, c in changed.items() if c} == {"labels", "cards"}
    assert rows[len(RUNS)].text == texts[len(RUNS)] and rows[len(RUNS) + 1].n_mail == 1
    assert all(len(rows[i].text) == len(t) for i, t in enumerate(texts))


def test_repeated_headers_and_codings_of_a_response():
    page = "<title>Grüße</title><p>é ü</p>"
    packed = gzip.compress(page.encode("latin-1"))
    chunks = b"".join(b"%x\r\n%s\r\n" % (len(packed[i : i + 10]), packed[i : i + 10]) for i in range(0, len(packed), 10)) + b"0\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n"
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Concurrent-To", "<urn:a>"), ("WARC-Concurrent-To", "<urn:b>")]
    ((headers, block),) = warc.parse_records(warc.record_bytes(fields, http + chunks))
    (_, _, metadata), (_, _, text) = warc.derived(headers, block)
    assert "source-warc-concurrent-to: <urn:a>\r\nsource-warc-concurrent-to: <urn:b>" in metadata.decode() and "title: Grüße" in metadata.decode()
    assert text.decode() == "é ü" and headers["warc-concurrent-to"] == "<urn:a>"
    for bad in (b"not gzip", b"zz\r\nx", b""):
        assert isinstance(warc.page_text(["Content-Encoding: gzip", "Transfer-Encoding: chunked", "Content-Type: x; charset=nope"], bad), str)
