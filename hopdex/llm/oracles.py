"""The corpus queries that SQL can express, as SQL over the same tables."""

from hopdex.llm import filter_audit, line_rules, url_rules

ORACLES = {
    "op4_line_rules": line_rules.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op9_url_rules": url_rules.ORACLE,
}
