"""Connectors against a service on this machine."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from chronoloom.plans.providers import Retrying, ask, embedded
from chronoloom.plans.services import ChatService, EmbeddingService, Refused


@pytest.fixture(scope="module")
def service():
    calls = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            calls.append(body)
            if self.path == "/busy" and len([c for c in calls if c.get("model") == body["model"]]) == 1:
                self.send_response(429)
                self.send_header("Retry-After", "7")
                self.end_headers()
                return
            if "input" in body:
                out = {"data": [{"index": i, "embedding": [float(len(t))]} for i, t in reversed(list(enumerate(body["input"])))]}
            elif body.get("max_tokens", 9_999) < 2_000:
                out = {"choices": [{"finish_reason": "length", "message": {"content": "{"}}]}
            else:
                asked = json.loads(body["messages"][1]["content"])
                out = {"choices": [{"finish_reason": "stop", "message": {"content": json.dumps({"echo": asked}) if asked.get("fine", True) else "[1]"}}]}
            content = json.dumps(out).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(content)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", calls
    server.shutdown()


def test_chat(service):
    url, calls = service
    chat = ChatService(f"{url}/chat", "m", "Answer in JSON.", {"Authorization": "Bearer x"})
    assert chat.answer({"a": "ä"}) == {"echo": {"a": "ä"}} and calls[-1]["response_format"] == {"type": "json_object"}
    assert chat.answer({"a": 1, "max_tokens": 1_000}) == {"cut": True}
    with pytest.raises(ValueError):
        chat.answer({"fine": False})
    with pytest.raises(Refused) as e:
        ChatService(f"{url}/busy", "first", "").answer({})
    assert e.value.retry_after == 7.0
    waits = []
    # Refused once, then cut once, then answered with more room.
    assert Retrying(ChatService(f"{url}/busy", "second", ""), sleep=waits.append).answer({"b": 2}) == {"echo": {"b": 2}} and 7.0 in waits


def test_in_tasks(spark, service):
    url, _ = service
    asked = spark.createDataFrame([("1", '{"a": 1}'), ("2", '{"fine": false}')], "custom_id string, payload string")
    got = {r["custom_id"]: r for r in ask(asked, lambda: ChatService(f"{url}/chat", "m", ""), timed=True).collect()}
    assert json.loads(got["1"]["response"]) == {"echo": {"a": 1}} and got["2"]["error"].startswith("ValueError") and got["1"]["seconds"] > 0
    texts = spark.createDataFrame([(i, "x" * i) for i in range(1, 8)], "id int, text string")
    assert {r["id"]: r["vector"] for r in embedded(texts, lambda: EmbeddingService(f"{url}/embed", "m"), most=3).collect()} == {i: [float(i)] for i in range(1, 8)}
