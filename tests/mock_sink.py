"""An HTTP endpoint that keeps what is posted to it, and can be slow or fail from some request on."""

from __future__ import annotations

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer


class MockSink:
    def __init__(self, delay_ms: int = 0, fail_after: int | None = None):
        self.delay_ms, self.fail_after = delay_ms, fail_after
        self.received: list[tuple[dict, bytes]] = []
        self.first = self.last = None
        outer = self

        class Handler(BaseHTTPRequestHandler):
            protocol_version = "HTTP/1.1"

            def do_POST(self):
                body = self.rfile.read(int(self.headers["Content-Length"]))
                if self.path == "/reset":
                    outer.received.clear()
                elif outer.fail_after is not None and len(outer.received) >= outer.fail_after:
                    return self._answer(503, b"no room " + b"x" * 500)
                else:
                    time.sleep(outer.delay_ms / 1000)
                    outer.received.append((dict(self.headers), body))
                    outer.last = time.time()
                    outer.first = outer.first or outer.last
                self._answer(202, b"")

            def do_GET(self):
                told = {"count": len(outer.received), "bytes": sum(len(b) for _, b in outer.received)}
                self._answer(200, json.dumps(told).encode())

            def _answer(self, status, body):
                self.send_response(status)
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}/events"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def __enter__(self):
        return self

    def __exit__(self, *error):
        self.server.shutdown()
        self.server.server_close()
