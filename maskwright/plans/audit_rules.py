"""Rules of the residual audit: what may not be left in masked text, and how bad it is."""

from __future__ import annotations

from dataclasses import dataclass

from .catalog import BASE58, BECH32, OCTET, RC_DATE

LEVELS = {"critical": 0, "high": 1, "medium": 2}


@dataclass(frozen=True)
class AuditRule:
    label: str
    severity: str
    pattern: str


# Patterns by severity.
CRITICAL = [
    ("IBAN-like sequence", r"\b[A-Z]{2}\d{2}\s?(?:[A-Z0-9]\s?){15,30}\b"),
    ("16-digit card-like sequence", r"\b(?:4|5[1-5]|6[02]|35|3[68])\d{2}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b"),
    ("Amex-like sequence", r"\b3[47]\d{2}[\s-]?\d{6}[\s-]?\d{5}\b"),
    ("US SSN format", r"\b(?!000|666|9\d{2})\d{3}-(?!00)\d{2}-(?!0000)\d{4}\b"),
    ("Bitcoin legacy address", r"\b(?:1|3)[a-km-zA-HJ-NP-Z1-9]{25,34}\b"),
    ("Bitcoin bech32 address", rf"\bbc1[{BECH32}]{{38,90}}\b"),
    ("Ethereum address", r"\b0x[a-fA-F0-9]{40}\b"),
    ("Monero address", rf"\b4[0-9AB][{BASE58}]{{93}}\b"),
    ("OpenAI API key", r"\bsk-(?!ant-)(?:proj-|svcacct-|admin-)?[A-Za-z0-9_-]{20,}\b"),
    ("Anthropic API key", r"\bsk-ant-(?:api\d{2}-)?[A-Za-z0-9_-]{30,}\b"),
    ("GitHub classic PAT", r"\bghp_[A-Za-z0-9]{36,40}\b"),
    ("GitHub fine-grained PAT", r"\bgithub_pat_[A-Za-z0-9_]{40,90}\b"),
    ("AWS access key", r"\bAKIA[0-9A-Z]{16}\b"),
    ("Stripe API key", r"\b(?:sk|pk)_(?:live|test)_[A-Za-z0-9]{24,}\b"),
    ("Slack token", r"\bxox[abprs]-[A-Za-z0-9-]{10,}\b"),
]
HIGH = [
    ("e-mail address", r"\b[\w.+-]+@[\w-]+\.[\w.-]+\b"),
    ("international phone number", r"\+\d{1,3}[\s-]?\(?\d{1,5}\)?[\s-]?\d{3,5}[\s-]?\d{3,5}\b"),
    ("CZ rodné číslo", rf"\b{RC_DATE}\s?/\s?\d{{3,4}}\b"),
    ("CZ bankovní účet (s prefixem)", r"\b\d{2,10}-\d{2,10}/\d{4}\b"),
    ("FR INSEE/NIR", r"\b[12]\s?\d{2}\s?(?:0[1-9]|1[0-2]|2[0-9]|3[0-9])\s?\d{2}\s?\d{2,3}\s?\d{2,3}(?:\s?\d{2})?\b"),
    ("IT codice fiscale", r"\b[A-Z]{6}\d{2}[A-EHLMPRT]\d{2}[A-Z]\d{3}[A-Z]\b"),
    ("ES DNI/NIE", r"\b[XYZ]?\d{7,8}[A-HJ-NP-TV-Z]\b"),
    ("UK NIN", r"\b[A-Z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[A-D]\b"),
    ("IN Aadhaar", r"\b[2-9]\d{3}\s\d{4}\s\d{4}\b"),
    ("BR CPF", r"\b\d{3}\.\d{3}\.\d{3}-\d{2}\b"),
    ("BR CNPJ", r"\b\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}\b"),
    ("KR RRN", r"\b\d{6}-[1-4]\d{6}\b"),
    ("ZH 身份证 (18-digit)", r"\b\d{17}[\dXx]\b"),
    ("FI henkilötunnus", r"\b\d{6}[+\-A]\d{3}[\dA-Y]\b"),
    ("IPv4 address", rf"\b(?:{OCTET}\.){{3}}{OCTET}\b"),
    ("MAC address", r"\b(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}\b"),
]
MEDIUM = [("11-12 digit block (potential national ID)", r"(?<!\d)\d{11,12}(?!\d)")]

AUDIT = [AuditRule(label, severity, p) for severity, rows in (("critical", CRITICAL), ("high", HIGH), ("medium", MEDIUM)) for label, p in rows]


def at_least(threshold: str) -> list[AuditRule]:
    """Rules at or above a severity."""
    return [r for r in AUDIT if LEVELS[r.severity] <= LEVELS[threshold]]
