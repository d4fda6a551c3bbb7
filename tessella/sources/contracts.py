"""What an extractor's answers must hold: fields, types and closed lists, checked natively over a JSON column."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: JSON types, and the first characters by which the text of a value tells them apart
KINDS = {"string": '^"', "integer": "^-?[0-9]+$", "number": "^-?[0-9]", "array": "^\\[", "null": "^null$", "object": "^\\{", "boolean": "^(?:true|false)$"}


@dataclass(frozen=True)
class Contract:
    """required fields; types: the kinds that a field may have; closed: the values that a field may have."""

    required: tuple[str, ...]
    types: dict[str, tuple[str, ...]] = field(default_factory=dict)
    closed: dict[str, tuple[str, ...]] = field(default_factory=dict)


_TEXT = ("string",)


def _texts(*names: str) -> dict[str, tuple[str, ...]]:
    return dict.fromkeys(names, _TEXT)


# The contracts of the extractor's answers.
CONTRACTS = {
    "facts": Contract(("founders", "city", "description"), _texts("founders", "city", "description", "website", "funding_info", "tech_keywords", "business_indicators", "regional_presence") | {"founded_year": ("integer", "null", "string")}),
    "classes": Contract(("sector", "tag", "AI_Use_Case", "business_model", "entity_type"), _texts("sector", "tag", "AI_Use_Case", "business_model", "entity_type", "reasoning"), {"business_model": ("Product", "Consultancy", "Hybrid", "Unknown")}),
    "record": Contract(("sector", "tag", "description"), _texts("website", "description", "city", "founders", "sector", "tag", "AI_Use_Case", "Total_Funding", "Investors", "Tech_Mentioned", "Tech_Assumed", "business_model", "entity_type")),
    "news": Contract(("headline", "event_type"), _texts("funding_amount", "round_type", "funding_date", "event_type", "sentiment") | {"headline": ("string", "array"), "summary": ("string", "array"), "companies": ("array",), "investors": ("array",)}),
}


def issues(answer: Column, contract: Contract) -> Column:
    """What a JSON answer breaks of its contract, in the order of its fields; `no answer` for null or no object."""
    value = lambda f: F.get_json_object(answer, f"$.{f}")
    raw = F.from_json(answer, "map<string,string>")
    there = lambda f: F.map_contains_key(raw, F.lit(f))
    # get_json_object drops the quotes of strings: a value is a string if no other kind fits its place in the text
    quoted = lambda f: F.regexp_like(answer, F.lit(f'"{f}"\\s*:\\s*"'))
    out = [F.when(~there(f), f"{f} missing") for f in contract.required]
    for f, kinds in contract.types.items():
        fits = F.lit(False)
        for k in kinds:
            fits = fits | (quoted(f) if k == "string" else F.regexp_like(answer, F.lit(f'"{f}"\\s*:\\s*null')) if k == "null" else ~quoted(f) & F.coalesce(value(f).rlike(KINDS[k]), F.lit(False)))
        out.append(F.when(there(f) & ~fits, f"{f} of another type"))
    for f, values in contract.closed.items():
        out.append(F.when(there(f) & ~F.coalesce(value(f).isin(*values), F.lit(False)), f"{f} not in list"))
    found = F.filter(F.array(*out), lambda x: x.isNotNull())
    return F.when(answer.isNull() | raw.isNull() | ~F.coalesce(F.ltrim(answer).startswith("{"), F.lit(False)), F.array(F.lit("no answer"))).otherwise(found)


def checked(answers: DataFrame, column: str, contract: str | Contract) -> DataFrame:
    """answers with `issues`, a list that is empty for a sound answer."""
    c = CONTRACTS[contract] if isinstance(contract, str) else contract
    return answers.withColumn("issues", issues(F.col(column), c))


def routed(answers: DataFrame, column: str, contract: str | Contract, tries: str = "tries", most: int = 3) -> DataFrame:
    """answers with `route`: `accept` for a sound one, `retry` while its tries are below `most`, else `review`."""
    x = checked(answers, column, contract)
    return x.withColumn("route", F.when(F.size("issues") == 0, "accept").when(F.coalesce(F.col(tries), F.lit(0)) < most, "retry").otherwise("review"))
