"""Text for reviewers: retrieval query, prompt, template brief, and the check of its citations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from queuecraft.functions.labels import risk_level
from queuecraft.operators.chunking import _strip
from queuecraft.operators.triage import MIDDLE, TOP

# Wording of the query, the brief and the caption; counts and pattern of citations.
QUERY_OPENING = "Auto insurance claim analysis."
QUERY_FIELDS = {
    "BasePolicy": "Base policy: %s.",
    "Fault": "Fault: %s.",
    "PoliceReportFiled": "Police report filed: %s.",
    "WitnessPresent": "Witness present: %s.",
    "VehicleCategory": "Vehicle category: %s.",
    "AgentType": "Agent type: %s.",
    "AddressChange_Claim": "Address change: %s.",
    "Deductible": "Deductible: $%s.",
}
QUERY_REASONS = "Risk factors identified:"
N_REASONS = 5
BRIEF_FIELDS = ["BasePolicy", "Fault", "VehicleCategory", "PoliceReportFiled", "WitnessPresent", "AgentType",
                "AddressChange_Claim", "Deductible", "Age"]
N_CITED = 3
SNIPPET = 200
CITATION = r"(?i)\[Source\s+(\d+)"
ACTIONS = {
    TOP: [
        "This claim is recommended for **SIU Escalation**. The Special Investigations Unit should:",
        "  1. Review the complete claim file and all supporting documentation",
        "  2. Conduct recorded interviews with the policyholder",
        "  3. Perform vehicle inspection or independent appraisal",
        "  4. Cross-reference against NICB fraud database",
        "  5. Complete investigation within 30 business days",
    ],
    MIDDLE: [
        "This claim requires **Manual Review**. The reviewer should:",
        "  1. Verify police report details against the claim",
        "  2. Confirm policyholder identity and coverage status",
        "  3. Validate repair estimates against industry benchmarks",
        "  4. Review and assess machine-generated reason codes",
        "  5. Complete review within 10 business days",
    ],
}
ACTION_REST = [
    "This claim is recommended for **Standard Approval**. Process through automated workflow.",
    "Note: This claim will be part of the quarterly random sampling audit.",
]
# This library's own wording; callers may pass theirs.
PROMPT_OPENING = "Write a short brief about the claim below for the person who has to decide on it."
PROMPT_INSTRUCTIONS = """## Instructions
Use two or three plain paragraphs. Say what the listed factors mean for this claim: a "High risk" factor
speaks for a closer look, a "Low risk" factor for a routine claim. Cite only the numbered sources above,
as [Source N]. Recommend next steps that fit the triage bucket, and keep to its tone: concerns first for
SIU, open checks first for Manual Review, reassurance first for Approve. Mention no scores or weights."""


def _lines(*parts: Column) -> Column:
    """Join non-empty line arrays."""
    return F.array_join(F.concat(*parts), "\n")


def _given(fields: Mapping[str, Column], wording: Mapping[str, str]) -> Column:
    """The worded fields that have a value, in fixed order."""
    worded = [F.when(fields[name].isNotNull(), F.format_string(form, fields[name].cast("string")))
              for name, form in wording.items() if name in fields]
    return F.array_compact(F.array(*worded)) if worded else F.array().cast("array<string>")


def retrieval_query(fields: Mapping[str, Column], reasons: Column) -> Column:
    """Query text from the attributes present and the first reasons; empty input gives an empty text."""
    attributes = _given(fields, QUERY_FIELDS)
    any_field = F.lit(False)
    for c in fields.values():
        any_field = any_field | c.isNotNull()
    none = F.array().cast("array<string>")
    opening = F.when(any_field, F.concat(F.array(F.lit(QUERY_OPENING)), attributes)).otherwise(none)
    listed = F.transform(F.slice(F.coalesce(reasons, none), 1, N_REASONS), lambda r: F.concat(F.lit("- "), r))
    closing = F.when(F.size(listed) > 0, F.concat(F.array(F.lit(QUERY_REASONS)), listed)).otherwise(none)
    return F.array_join(F.concat(opening, closing), " ")


def clean_reason(reason: Column) -> Column:
    """Without the strength mark in front and the number behind."""
    bare = F.regexp_replace(reason, r"^\[[A-Z]+\]\s*", "")
    return _strip(F.regexp_replace(bare, r"\s*\(SHAP:[^)]*\)", ""))


def _numbered(passages: Column, word) -> Column:
    return F.transform(passages, lambda p, i: word(p, (i + 1).cast("string")))


def prompt_text(fields: Mapping[str, Column], score: Column, bucket: Column, reasons: Column, passages: Column,
                opening: str = PROMPT_OPENING, instructions: str = PROMPT_INSTRUCTIONS) -> Column:
    """The prompt for a text model, as a column; calling a model is outside the library.

    ``passages`` is an array of struct(source, text).
    """
    pairs = F.array_compact(F.array(*[F.when(c.isNotNull(), F.concat(F.lit(f"{n}: "), c.cast("string"))) for n, c in fields.items()]))
    summary = F.when(F.size(pairs) > 0, F.array_join(pairs, ", ")).otherwise("No claim data available")
    factors = F.array_join(F.transform(reasons, lambda r: F.concat(F.lit("- "), clean_reason(r))), "\n")
    context = F.array_join(_numbered(passages, lambda p, i: F.concat(
        F.lit("[Source "), i, F.lit(": "), p["source"], F.lit("]\n"), p["text"])), "\n\n")
    return F.concat(
        F.lit(opening + "\n\n## Claim Data\n"), summary, F.lit("\n\n## Risk Score: "), F.format_string("%.4f", score),
        F.lit("\n## Triage Bucket: "), bucket, F.lit("\n\n## Machine-Generated Risk Factors (SHAP Analysis)\n"), factors,
        F.lit("\n\n## Relevant Policy Guidelines\n"), context, F.lit("\n\n" + instructions))


def template_brief(fields: Mapping[str, Column], score: Column, bucket: Column, reasons: Column, passages: Column) -> Column:
    """A brief from a fixed template; it cites the passages it was given, by number."""
    none = F.array().cast("array<string>")
    lines = lambda *texts: F.array(*[F.lit(t) if isinstance(t, str) else t for t in texts])
    dashed = lambda a: F.transform(a, lambda r: F.concat(F.lit("  - "), r))
    high = F.filter(reasons, lambda r: F.contains(r, F.lit("High risk")))
    low = F.filter(reasons, lambda r: F.contains(r, F.lit("Low risk")))
    found = F.concat(F.lit("This claim has been flagged with "), F.size(high).cast("string"), F.lit(" risk indicator(s):"))
    risks = F.when(F.size(high) > 0, F.concat(lines(found), dashed(high))).otherwise(
        lines("No significant risk indicators were identified for this claim."))
    relief = F.when(F.size(low) > 0, F.concat(
        lines("\nThe following factor(s) reduce the overall risk assessment:"), dashed(low))).otherwise(none)
    details = _given(fields, {n: f"  - **{n}:** %s" for n in BRIEF_FIELDS})
    snippet = lambda p: F.concat(
        _strip(F.replace(F.substring(p["text"], 1, SNIPPET), F.lit("\n"), F.lit(" "))),
        F.when(F.length(p["text"]) > SNIPPET, "...").otherwise(""))
    cited = _numbered(F.slice(passages, 1, N_CITED), lambda p, i: F.concat(
        F.lit("  - [Source "), i, F.lit(": "), p["source"], F.lit("] "), snippet(p)))
    action = F.when(F.lit(False), none)
    for name, texts in ACTIONS.items():
        action = action.when(bucket == name, lines(*texts))
    return _lines(
        lines("## Triage Brief",
              F.concat(F.lit("**Risk Score:** "), F.format_string("%.4f", score), F.lit(" ("), risk_level(score), F.lit(")")),
              F.concat(F.lit("**Triage Bucket:** "), bucket), "", "### Risk Assessment"),
        risks, relief, lines("", "### Claim Details"), details, lines("", "### Applicable Guidelines"), cited,
        lines("", "### Recommended Action"), action.otherwise(lines(*ACTION_REST)))


def citation_check(brief: Column, n_passages: Column) -> Column:
    """Which sources a brief cites and which of them exist. No brief cites nothing and is fine."""
    numbers = F.regexp_extract_all(F.coalesce(brief, F.lit("")), F.lit(CITATION), F.lit(1))
    # decimal holds any number a text may carry
    cited = F.array_sort(F.array_distinct(F.transform(numbers, lambda x: F.try_to_number(x, F.lit("9" * 38)))))
    cited = F.filter(cited, lambda x: x.isNotNull())
    real = lambda x: (x >= 1) & (x <= n_passages)
    invalid = F.filter(cited, lambda x: ~real(x))
    return F.struct(cited.alias("cited"), F.filter(cited, real).alias("valid"), invalid.alias("invalid"),
                    n_passages.alias("n_passages"), (F.size(invalid) == 0).alias("ok"))


def annotate_invalid(brief: Column, invalid: Column) -> Column:
    """Mark citations of sources that do not exist; the text around them stays."""
    return F.aggregate(invalid, brief, lambda text, n: F.regexp_replace(
        text, F.concat(F.lit(r"(?i)\[Source\s+"), n.cast("string"), F.lit(r"\b")),
        F.concat(F.lit("[UNVERIFIED Source "), n.cast("string"))))


def citation_caption(check: Column) -> Column:
    n = lambda name: F.size(check[name]).cast("string")
    total = check["n_passages"].cast("string")
    listed = F.concat(F.lit("["), F.array_join(F.transform(check["invalid"], lambda x: x.cast("string")), ", "), F.lit("]"))
    return (F.when(check.isNull(), "citations unchecked")
            .when(F.size(check["cited"]) == 0, F.concat(F.lit("no citations · "), total, F.lit(" passages retrieved")))
            .when(check["ok"], F.concat(F.lit("✅ "), n("valid"), F.lit("/"), n("cited"),
                                        F.lit(" citations verified against "), total, F.lit(" retrieved passages")))
            .otherwise(F.concat(F.lit("⚠️ "), n("invalid"), F.lit(" unverified citation(s): "), listed,
                                F.lit(" — not among the "), total, F.lit(" retrieved"))))
