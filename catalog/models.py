"""Deterministic stand-ins for models, so that results can be compared."""

from __future__ import annotations

import hashlib
import json

from replyloom.operators.inference import Backend, BackendError


class DigestJudge(Backend):
    """Scores read off the MD5 digest of the prompt; prose when the digest starts with 0."""

    def generate(self, prompt: str, messages: list | None, params: dict) -> dict:
        digest = hashlib.md5(prompt.encode("utf-8")).hexdigest()
        if digest[0] == "0":
            return {"text": "I would rather not say."}
        score = {
            "correctness": int(digest[:4], 16) % 51,
            "logic": int(digest[4:8], 16) % 26,
            "clarity": int(digest[8:12], 16) % 16,
            "completeness": int(digest[12:16], 16) % 11,
        }
        score["total_score"] = sum(score.values())
        score["brief_comment"] = digest
        return {"text": f"Verdict:\n<result>\n{json.dumps(score)}\n</result>"}


class DigestBackend(Backend):
    """Deterministic stand-in for a model: the reply is the MD5 digest of the prompt."""

    def __init__(self, prefix: str = "answer "):
        self.prefix = prefix

    def generate(self, prompt: str, messages: list | None, params: dict) -> dict:
        text = self.prefix + hashlib.md5(prompt.encode("utf-8")).hexdigest()
        counts = {"prompt_tokens": len(prompt.split()), "completion_tokens": len(text.split())}
        return {"choices": [{"message": {"content": text}}], "usage": counts}


class RefusingJudge(DigestJudge):
    """A judge that fails for good on prompts whose digest starts with a letter."""

    def generate(self, prompt: str, messages: list | None, params: dict) -> dict:
        digest = hashlib.md5(prompt.encode("utf-8")).hexdigest()
        if digest[0] in "abcdef":
            raise BackendError(f"refused {digest[:8]}", 400)
        return super().generate(prompt, messages, params)


class FlakyBackend(Backend):
    """Fails for a while: none, one or two calls per prompt, by its digest."""

    def __init__(self):
        self.calls: dict[str, int] = {}

    def generate(self, prompt: str, messages: list | None, params: dict) -> dict:
        digest = hashlib.md5(prompt.encode("utf-8")).hexdigest()
        calls = self.calls[digest] = self.calls.get(digest, 0) + 1
        if calls <= int(digest[0], 16) % 3:
            raise BackendError("busy", 503)
        del self.calls[digest]  # a prompt may come again
        return {"text": f"answer {digest} after {calls}"}


class PickyBackend(Backend):
    """Rejects stop words for prompts whose digest starts with a letter; tells what it got."""

    def generate(self, prompt: str, messages: list | None, params: dict) -> dict:
        digest = hashlib.md5(prompt.encode("utf-8")).hexdigest()
        if "stop" in params and digest[0] in "abcdef":
            raise BackendError("no stop words here", 400)
        return {"text": f"answer {digest} with {','.join(sorted(params))}"}


class MoodyBackend(Backend):
    """Fails for good on prompts whose digest starts with a letter."""

    def generate(self, prompt: str, messages: list | None, params: dict) -> dict:
        digest = hashlib.md5(prompt.encode("utf-8")).hexdigest()
        if digest[0] in "abcdef":
            raise BackendError(f"refused {digest[:8]}", 400)
        text = f"answer {digest}"
        return {
            "choices": [{"message": {"content": text, "reasoning": f" {digest[8:]} "}}],
            "usage": {"prompt_tokens": len(prompt), "completion_tokens": len(text)},
        }


class BatchBackend(DigestBackend):
    """Answers batches; one with a prompt that it refuses fails as a whole."""

    def generate_many(self, prompts: list[str], messages: list, params: dict) -> list[dict]:
        digests = [hashlib.md5(p.encode("utf-8")).hexdigest() for p in prompts]
        if any(d[0] == "0" for d in digests):
            raise BackendError("a prompt of the batch is refused", 400)
        return [{"text": f"{json.dumps(params, sort_keys=True)} {d}"} for d in digests]


def ask_again(texts: list[str], state: dict) -> tuple[bool, str | None, dict]:
    """Turn callback: ask about the last reply until one ends in a digit, three times at most."""
    turns = state.get("turns", 0) + 1
    go_on = not texts[-1][-1].isdigit() and turns < 3
    return go_on, f"and {texts[-1]}?", {"turns": turns}
