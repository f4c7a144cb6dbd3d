"""Health, readiness and metrics of running queries, as functions and over HTTP."""

from __future__ import annotations

import json
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from threading import Thread

from .metrics import Metrics


def health() -> tuple[int, dict]:
    return 200, {"status": "ok"}


def readiness(queries: list, storage: Callable[[], bool]) -> tuple[int, dict]:
    """503 unless the storage answers and every query runs without an exception."""
    checks = {"storage": "ok" if storage() else "failed"}
    for q in queries:
        checks[f"query_{q.name or q.id}"] = "ok" if q.isActive and q.exception() is None else "failed"
    ready = all(v == "ok" for v in checks.values())
    return 200 if ready else 503, {"status": "ready" if ready else "not_ready", "checks": checks}


def serve(listen: str, queries: list, storage: Callable[[], bool], metrics: Metrics) -> ThreadingHTTPServer:
    """Serves /healthz, /readyz and /metrics in a thread; shutdown() ends it."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path == "/metrics":
                code, body, kind = 200, metrics.text(), "text/plain; version=0.0.4"
            elif self.path in ("/healthz", "/readyz"):
                code, found = health() if self.path == "/healthz" else readiness(queries, storage)
                body, kind = json.dumps(found), "application/json"
            else:
                code, body, kind = 404, "not found", "text/plain"
            self.send_response(code)
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *args):
            pass

    host, _, port = listen.rpartition(":")
    server = ThreadingHTTPServer((host or "0.0.0.0", int(port)), Handler)
    Thread(target=server.serve_forever, daemon=True).start()
    return server
