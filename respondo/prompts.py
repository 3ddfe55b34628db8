"""Prompts by branch: defaults, branches, variables, messages and parameters. Driver-side configuration."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from .functions.text import template, template_names

#: Parameters that models without sampling control do not take.
SAMPLING = ("temperature", "stop", "max_tokens")


@dataclass(frozen=True)
class Prompt:
    system: str
    user: str
    model: str
    parameters: dict = field(default_factory=dict)
    schema: str | None = None

    def names(self) -> list[str]:
        return list(dict.fromkeys([*template_names(self.system), *template_names(self.user)]))


def merged(base: dict, over: dict) -> dict:
    """`over` on top of `base`, one nested level deep."""
    return base | {k: base[k] | v if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}


class PromptRegistry:
    """Prompts as nested dictionaries: version, defaults and branches."""

    def __init__(self, config: dict):
        self.version = config.get("version")
        self.defaults = config.get("defaults", {})
        self.branches = config.get("branches", {})

    @classmethod
    def read(cls, path: str) -> PromptRegistry:
        """From a YAML or JSON file."""
        text = Path(path).read_text(encoding="utf-8")
        if path.endswith(".json"):
            import json

            return cls(json.loads(text))
        import yaml

        return cls(yaml.safe_load(text))

    def resolve(self, branch: str) -> dict:
        """The settings of a branch over the defaults; an unknown branch is a KeyError."""
        return merged(self.defaults, self.branches[branch])

    def get(self, branch: str, **parameters) -> Prompt:
        """The prompt of a branch; parameters of the call win over the branch's, those over the defaults. A
        branch without model or template is a ValueError."""
        found = self.resolve(branch)
        if not found.get("model") or not (found.get("user") or found.get("system")):
            raise ValueError(f"branch {branch} has no model or no template")
        settings = merged(found.get("parameters", {}), parameters)
        if not found.get("sampling", True):
            settings = {k: v for k, v in settings.items() if k not in SAMPLING}
        return Prompt(found.get("system", "").strip(), found.get("user", "").strip(), found["model"], settings, found.get("schema", branch))

    def by_length(self, text: Column, short: str, long: str, limit: int = 3000) -> Column:
        """The branch for a text: `long` above the limit."""
        return F.when(F.length(text) > limit, F.lit(long)).otherwise(F.lit(short))

    def messages(self, branch: str, extras: list[tuple[str, str]] = (), **values: Column | str) -> Column:
        """An array of (role, content) for every row: system, user, extras. A variable that is not given is a
        KeyError when the plan is built."""
        prompt = self.get(branch)
        parts = [("system", template(prompt.system, **values)), ("user", template(prompt.user, **values))]
        parts += [(role, F.lit(text)) for role, text in extras]
        return F.array(*[F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in parts])


DEFAULT = PromptRegistry(
    {
        "version": 1,
        "defaults": {"model": "rules", "parameters": {"temperature": 0.0}},
        "branches": {
            "grammar": {"system": "Correct spelling and spacing. Answer with JSON: corrected.", "user": "{text}"},
            "sentence": {"system": "Split into at most three sentences; give polarity and keywords as JSON.", "user": "Question: {question}\nAnswer: {text}"},
            "depend": {"system": "The answer explains a choice: {sub_explanation}", "user": "Question: {question}\nAnswer: {text}"},
            "choices": {"system": "List the numbered choices of the question as JSON.", "user": "{question}"},
            "survey_context": {"system": "Summarise the questionnaire in two or three sentences.", "user": "{text}"},
        },
    }
)
