"""Declared schemas, statuses, gates and edge tables. Everything here is data."""

from __future__ import annotations

# Candidate file suffixes and the format each one names.
FILE_FORMATS = {
    ".csv": "CSV", ".jsonl": "JSONL", ".ndjson": "NDJSON", ".parquet": "Parquet",
    ".sqlite": "SQLite", ".sqlite3": "SQLite", ".db": "SQLite", ".arrow": "Arrow", ".feather": "Feather",
}

# Statuses of a member, worst first; the position is the rank.
STATUSES = ["failed", "rejected", "expired", "undetermined", "immature", "not_executed", "proven"]

# Availability verdicts, worst first.
AVAILABILITY = ["unavailable", "undetermined", "limited", "available"]

# The nine fields of a source identity.
IDENTITY_FIELDS = [
    "provider", "venue", "market_type", "symbol_identity", "contract",
    "data_object", "schema_version", "authorization", "field_mapping",
]

# Allowed steps of a simulated order.
LIFECYCLE_EDGES = [
    ("created", "sent"), ("sent", "acknowledged"), ("acknowledged", "evaluated"),
    ("evaluated", "filled"), ("evaluated", "canceled"), ("evaluated", "unknown"),
]

# Scenario grid of a simulated order.
SIDES = ["buy", "sell"]
ORDER_KINDS = ["aggressive_market", "aggressive_limit", "passive_limit_cancel"]
CLOCKS = ["baseline", "stress"]
PASSIVE_REASON = "QUEUE_IDENTITY_UNAVAILABLE"

# Permission gates in the order they are asked.
PERMISSION_GATES = ["data", "sample", "edge", "cost", "risk", "execution", "discipline"]

# Main scales in hours, outcome-only windows in minutes.
STATE_SCALES_H = [4, 8, 24, 48]
OUTCOME_WINDOWS_M = [15, 60]
OUTCOME_HORIZONS_M = [15, 60, 240, 480, 1440, 2880]

# Cost components.
COST_COMPONENTS = ["fee", "funding", "spread", "depth", "impact"]

# Physical column names allowed for each logical field of a declaration.
DECLARATION_ALIASES = {
    "member_no": ["member_id", "member_no", "成员编号", "成员ID"],
    "asset_no": ["asset_id", "asset_no", "资产编号"],
    "target": ["target", "asset", "symbol_target", "标的"],
    "symbol_identity": ["symbol", "asset_symbol", "instrument_symbol", "标的身份"],
    "provider": ["source_provider", "provider", "来源提供者"],
    "venue": ["venue", "exchange", "交易场所"],
    "market_type": ["market_type", "market", "市场类型"],
    "contract": ["contract", "instrument", "精确合约"],
    "data_object": ["data_object", "dataset", "数据对象"],
    "schema_version": ["schema_version", "schema_revision", "Schema确切版本"],
    "authorization": ["authorization_scope", "access_scope", "授权边界"],
    "field_mapping": ["field_mapping", "column_mapping", "字段中文映射"],
    "task_contract_version": ["contract_version", "task_contract_version", "任务合同版本"],
    "collected_at": ["collected_at", "collection_time", "collected_time", "采集时间"],
    "content_sha": ["declaration_sha256", "content_sha256", "声明内容SHA-256", "声明内容指纹"],
    "member_sha": ["member_sha256", "member_input_sha256", "输入成员SHA-256", "成员输入指纹"],
    "schema_sha": ["schema_sha256", "schema_fingerprint", "Schema指纹"],
    "authorization_sha": ["authorization_sha256", "authorization_fingerprint", "授权快照SHA-256", "授权指纹"],
    "revocation": ["revoked_at", "revocation_fact", "撤销事实", "撤销时间"],
    "declaration_version": ["declaration_version", "version", "声明版本"],
}

# Sensitive text, one pattern per rule (RE2 and Java read them alike).
SENSITIVE_PATTERNS = {
    "ipv4": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "private_key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "cloud_token": r"\bAKIA[0-9A-Z]{16}\b",
    "git_token": r"\bgh[pousr]_[A-Za-z0-9]{20,}\b",
    "assignment": r"(?i)\b(?:password|passwd|secret|token)\s*[:=]\s*[^\s,;]+",
}

# Literals without which a pattern cannot match; a text that holds none of them skips the pattern.
SENSITIVE_LITERALS = {
    "private_key": ["-----BEGIN"],
    "cloud_token": ["AKIA"],
    "git_token": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
}
