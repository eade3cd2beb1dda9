import http.server
import threading
from collections import Counter

import pytest

from quarrystone.sources import fetch

PDF = b"%PDF-1.4 some content"


class Answers(http.server.BaseHTTPRequestHandler):
    asked: Counter = Counter()

    def do_GET(self):
        Answers.asked[self.path] += 1
        n = Answers.asked[self.path]
        if self.path.startswith("/good") or (self.path.startswith("/third") and n >= 3):
            self._send(200, PDF)
        elif self.path.startswith("/third"):
            self._send(500, b"later")
        elif self.path.startswith("/html"):
            self._send(200, b"<html>not found</html>")
        elif self.path.startswith("/cut"):
            self._send(200, PDF, len(PDF) + 50)
        else:
            self._send(404, b"none")

    def _send(self, code, body, size=None):
        self.send_response(code)
        self.send_header("Content-Length", str(size or len(body)))
        self.end_headers()
        self.wfile.write(body)
        self.close_connection = True

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def place():
    Answers.asked.clear()
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_retries_and_fallback(spark, place):
    requests = [
        ("good", "/good/1", None), ("third", "/third/1", None), ("html", "/html/1", None), ("cut", "/cut/1", None), ("none", "/none/1", None), ("archived", "/none/2", "/good/2"),
        ("html archived", "/html/2", "/good/3"), ("nowhere", "/none/3", "/none/4"), ("only archive", None, "/good/5"), ("no address", None, None), ("odd", "nothing://x", None),
    ]
    rows = [(d, *(u and (place + u if u[0] == "/" else u) for u in us)) for d, *us in requests]
    df = spark.createDataFrame(rows, "document string, url string, other string")
    got = {r.document: r for r in fetch.fetch(df, attempts=3, pause=0).collect()}
    assert {d: (r.status, r.origin, r.attempts) for d, r in got.items()} == {
        "good": ("ok", "live", 1), "third": ("ok", "live", 3), "html": ("failed", None, 3), "cut": ("failed", None, 3), "none": ("absent", None, 1), "archived": ("ok", "archive", 2),
        "html archived": ("ok", "archive", 4), "nowhere": ("absent", None, 2), "only archive": ("ok", "archive", 1), "no address": ("absent", None, 0), "odd": ("failed", None, 3),
    }
    for r in got.values():
        assert (bytes(r.content) == PDF and r.bytes == len(PDF) and r.error is None) if r.status == "ok" else (r.content is None and r.error)
    # what is not there is asked for once
    assert Answers.asked["/none/1"] == 1


def test_waits_grow_by_the_attempt():
    waits = []
    assert fetch.asked("nothing://x", fetch.Policy(attempts=4, pause=2.0), waits.append)[:2] == ("failed", 4)
    assert waits == [2.0, 4.0, 6.0]


def test_least_size_and_magic(place):
    assert fetch.asked(place + "/good/9", fetch.Policy(attempts=1, least=10_000))[3] == f"{len(PDF)} bytes"
    assert fetch.asked(place + "/html/9", fetch.Policy(attempts=1, magic=b"<html"))[0] == "ok"


def test_no_requests(spark):
    assert fetch.fetch(spark.createDataFrame([], "document string, url string, other string")).count() == 0
