"""What a session needs of a text model, and a rule-based stand-in that runs offline and always answers alike."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from typing import Protocol

from dialoom.functions.lexicon import CHATTER, FACT_TYPES, MEDICAL_SIGNALS, STATUSES


class TextModel(Protocol):
    """Turns an utterance into facts, and a state into the next question; ``errors`` are those of the answer before."""

    def extract(self, utterance: str, question: str | None, state: dict, errors: list[str] | None = None) -> list[dict]: ...

    def ask(self, state: dict, asked: list[list[str]]) -> dict: ...


class RuleModel:
    """Facts are the known names in the utterance; the next question asks for the first attribute not known or asked."""

    NEGATIONS = ("没有", "没", "无", "不觉得", "并无", "否认")
    QUESTIONS = {"duration": "{}持续多久了？", "severity": "{}的程度怎么样？", "frequency": "{}一天几次？"}

    def __init__(self, names: dict[str, str]) -> None:
        self.names = names
        self.pattern = re.compile("|".join(map(re.escape, sorted(names, key=lambda n: (-len(n), n)))) or r"(?!)")

    def extract(self, utterance: str, question: str | None, state: dict, errors: list[str] | None = None) -> list[dict]:
        out = []
        for hit in self.pattern.finditer(utterance or ""):
            before = utterance[max(0, hit.start() - 3) : hit.start()]
            status = "absent" if before.endswith(self.NEGATIONS) else "present"
            out.append({"name": hit.group(), "normalized_name": hit.group(), "type": self.names[hit.group()], "status": status, "subject": "patient", "evidence": hit.group(), "attribute": {}})
        return out

    def ask(self, state: dict, asked: list[list[str]]) -> dict:
        for problem in state.get("problems") or []:
            for attribute, text in self.QUESTIONS.items():
                key = [problem["type"], problem["normalized_name"], attribute]
                if not (problem.get("attributes") or {}).get(attribute) and key not in asked:
                    return {"action": "ask", "target": key, "utterance": text.format(problem["normalized_name"])}
        return {"action": "end", "target": None, "utterance": ""}


#: Errors of a call that another attempt may mend; every other one ends it at once.
RETRYABLE = (ConnectionError, TimeoutError, OSError)


def with_retries(call: Callable, attempts: int = 3, base: float = 0.5, sleep: Callable[[float], None] = time.sleep, retryable: tuple[type[BaseException], ...] = RETRYABLE, jitter: Callable[[float, float], float] | None = None) -> Callable:
    """``call`` repeated after a ``retryable`` error, with exponential waiting; the last error is raised.

    ``jitter`` (such as ``random.uniform``) adds to each wait, so that many callers don't come back at once.
    """

    def tried(*args: object, **kwargs: object) -> object:
        least = max(0.5, base)
        for n in range(attempts):
            try:
                return call(*args, **kwargs)
            except retryable:
                if n + 1 == attempts:
                    raise
                sleep(least * 2**n + (jitter(0.0, least) if jitter else 0.0))
        return None

    return tried


def is_courtesy(text: str | None) -> bool:
    """Whether an utterance is courtesy alone, so that no model need read it: the predicate of messages, for one text."""
    bare = re.sub(r"[。！？!?，,、~～.\s]", "", text or "")
    rest = bare
    for phrase in sorted(CHATTER, key=lambda p: (-len(p), p)):
        rest = rest.replace(phrase, "")
    return bare != "" and (bare in CHATTER or (not rest and not any(w in bare for w in MEDICAL_SIGNALS)))


def raw_errors(facts: list[dict], utterance: str) -> list[str]:
    """What is wrong with extracted facts before anything is done with them, fact by fact."""
    errors = []
    for n, fact in enumerate(facts):
        if fact.get("type") not in FACT_TYPES:
            errors.append(f"facts[{n}].type invalid")
        if fact.get("status") not in STATUSES:
            errors.append(f"facts[{n}].status invalid")
        if not (fact.get("name") or "").strip():
            errors.append(f"facts[{n}].name empty")
        if not fact.get("evidence") or fact["evidence"] not in (utterance or ""):
            errors.append(f"facts[{n}].evidence not in utterance")
    return errors


def extracted_turn(model: TextModel, utterance: str, question: str | None, state: dict, attempts: int = 3) -> tuple[list[dict], int]:
    """Facts of a turn and the calls that they took: none for courtesy; an answer with errors is asked for again with them.

    Raises ValueError with the errors of the last attempt.
    """
    if is_courtesy(utterance):
        return [], 0
    errors: list[str] = []
    for n in range(1, attempts + 1):
        facts = model.extract(utterance, question, state, errors) if errors else model.extract(utterance, question, state)
        errors = raw_errors(facts, utterance)
        if not errors:
            return facts, n
    raise ValueError("; ".join(errors))


def asked_question(model: TextModel, state: dict, asked: list[list[str]], attempts: int = 3) -> tuple[dict, int]:
    """The next decision and the calls that it took; one that asks again for a target, or says nothing, is asked for again."""
    why = ""
    for n in range(1, attempts + 1):
        decision = model.ask(state, asked)
        asks = decision.get("action") == "ask"
        why = "asked already" if asks and decision.get("target") in asked else "says nothing" if asks and not (decision.get("utterance") or "").strip() else "" if asks or decision.get("action") == "end" else "no action"
        if not why:
            return decision, n
    raise ValueError(why)
