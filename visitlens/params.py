"""Task parameters (the analysis request) and their JSON form.

A task parameter document is a JSON object whose fields are arrays, of which only element 0 is
read; a multi-select is one comma-joined string, e.g. ``{"cities": ["NATION_1,NATION_2"]}``.
The driver only ever holds this small object; all data stays in Spark.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

# JSON field names of a task parameter document.
FIELD_NAMES = {
    "start_date": "startDate",
    "end_date": "endDate",
    "start_age": "startAge",
    "end_age": "endAge",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "category_ids": "categoryIds",
}
MULTI_VALUED = ("professionals", "cities", "keywords", "category_ids")
INTEGER_VALUED = ("start_age", "end_age")


# The rule that both forms of a task's parameters follow (here, and ``sources.task.checked_task_params`` for many tasks
# at once): a missing or empty document, a field that is no array, an empty array, null or empty text select
# nothing; a document that is no JSON object (or has a name twice) and an age that is no whole number of 32 bits are errors; a list is its
# comma-separated pieces without empty ones at the end, so "," lists nothing and matches nothing.
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
NOT_AN_OBJECT = "document: not a JSON object"


def whole_number(text: str) -> int | None:
    """A whole number of 32 bits, or None."""
    value = int(text) if re.match(WHOLE_NUMBER, text, re.ASCII) else None
    return value if value is not None and -(2**31) <= value < 2**31 else None


def _object(pairs: list[tuple[str, object]]) -> dict[str, object]:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("a name twice")
    return out


def _no_number(text: str) -> None:
    raise ValueError(text)


def split_csv(text: str) -> tuple[str, ...]:
    """Split on commas keeping inner empty pieces and dropping trailing ones."""
    parts = text.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return tuple(parts)


def first_element(value: object) -> str | None:
    """Element 0 of a JSON array as text; None when absent, not an array, or empty."""
    if isinstance(value, list):
        if not value or value[0] is None:
            return None
        head = value[0]
        return str(head) if isinstance(head, str) else json.dumps(head, separators=(",", ":"))
    return None


@dataclass(frozen=True)
class TaskParams:
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[str, ...] | None = None

    @classmethod
    def from_json(cls, text: str | None) -> TaskParams:
        """Parse a task parameter document (array fields, element 0 only). Errors raise ValueError, all of them named."""
        if not text:
            return cls()
        try:
            doc = json.loads(text, object_pairs_hook=_object, parse_constant=_no_number)
        except ValueError:
            doc = None
        if not isinstance(doc, Mapping):
            raise ValueError(NOT_AN_OBJECT)
        raw = {attr: first_element(doc.get(name)) for attr, name in FIELD_NAMES.items()}
        errors = [f"{FIELD_NAMES[a]}: not a whole number" for a in INTEGER_VALUED if raw[a] and whole_number(raw[a]) is None]
        if errors:
            raise ValueError("; ".join(errors))
        return cls.from_values(raw)

    @classmethod
    def from_values(cls, values: Mapping[str, object]) -> TaskParams:
        """Build from python values keyed by attribute name; strings for multi-valued fields are
        comma lists, sequences are taken as they are."""
        kwargs: dict[str, object] = {}
        for attr in FIELD_NAMES:
            value = values.get(attr)
            if value is None or value == "":  # an unselected field of a form filters nothing
                continue
            if attr in MULTI_VALUED:
                if isinstance(value, str):
                    value = split_csv(value)
                elif isinstance(value, Sequence):
                    value = tuple(str(v) for v in value)
            elif attr in INTEGER_VALUED:
                number = whole_number(str(value))
                if number is None:
                    raise ValueError(f"{FIELD_NAMES[attr]}: not a whole number")
                value = number
            else:
                value = str(value)
            kwargs[attr] = value
        return cls(**kwargs)

    def to_json(self) -> str:
        """The document form: every present field as a one-element array."""
        doc = {}
        for f in fields(self):
            value = getattr(self, f.name)
            if value is None:
                continue
            if isinstance(value, tuple):
                value = ",".join(value)
            doc[FIELD_NAMES[f.name]] = [str(value)]
        return json.dumps(doc, sort_keys=True)

    @property
    def has_age_range(self) -> bool:
        """The age predicate applies only when both bounds are given."""
        return self.start_age is not None and self.end_age is not None


def task_id_from_args(argv: Sequence[str] | None) -> int:
    """Task id from the first program argument, -1 when missing or not a number."""
    try:
        if argv:
            return int(argv[0])
    except ValueError:
        pass
    return -1
