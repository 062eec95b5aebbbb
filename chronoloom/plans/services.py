"""Connectors to services that answer over HTTP in the common JSON forms of chat completions and embeddings."""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from dataclasses import dataclass, field


class Refused(OSError):
    """A service that refused a call; ``retry_after`` are the seconds that it asks to wait, 0 if it doesn't say."""

    def __init__(self, message: str, retry_after: float = 0.0):
        super().__init__(message)
        self.retry_after = retry_after


def post(url: str, body: dict, headers: dict[str, str], timeout: float) -> dict:
    asked = urllib.request.Request(url, json.dumps(body, ensure_ascii=False).encode(), {"Content-Type": "application/json", **headers})
    try:
        with urllib.request.urlopen(asked, timeout=timeout) as reply:
            return json.loads(reply.read().decode())
    except urllib.error.HTTPError as e:
        wait = e.headers.get("Retry-After") or "0"
        raise Refused(f"HTTP {e.code}", float(wait) if wait.replace(".", "", 1).isdigit() else 0.0) from e


@dataclass
class ChatService:
    """A provider for ``providers.ask``: the payload goes as JSON below an instruction, the answer must be one JSON object.

    Wrap it in ``providers.Retrying`` for retries, pacing, and more room after cut answers: an answer that ran out of room has ``cut`` set.
    """

    url: str
    model: str
    instruction: str
    headers: dict[str, str] = field(default_factory=dict)
    temperature: float = 0.0
    timeout: float = 120.0

    def answer(self, payload: dict) -> dict:
        told = {k: v for k, v in payload.items() if k != "max_tokens"}
        messages = [{"role": "system", "content": self.instruction}, {"role": "user", "content": json.dumps(told, ensure_ascii=False, sort_keys=True)}]
        body = {"model": self.model, "messages": messages, "temperature": self.temperature, "response_format": {"type": "json_object"}}
        if "max_tokens" in payload:
            body["max_tokens"] = payload["max_tokens"]
        choice = post(self.url, body, self.headers, self.timeout)["choices"][0]
        if choice.get("finish_reason") == "length":
            return {"cut": True}
        answer = json.loads(choice["message"]["content"])
        if not isinstance(answer, dict):
            raise ValueError("the answer is no JSON object")
        return answer


@dataclass
class EmbeddingService:
    """An embedder for ``providers.embedded``: vectors in the order of the texts, whatever the order of the reply."""

    url: str
    model: str
    headers: dict[str, str] = field(default_factory=dict)
    timeout: float = 120.0

    def embed(self, texts: list[str]) -> list[list[float]]:
        reply = post(self.url, {"model": self.model, "input": texts}, self.headers, self.timeout)
        return [x["embedding"] for x in sorted(reply["data"], key=lambda x: x["index"])]
