"""Rule values of the default taxonomy.

Everything between the two markers is a fixed value: results are only right
when these patterns, terms, names and numbers are exactly these. Callers with
another taxonomy pass their own ``RulePacks`` instead (see ``packs.py``).
"""

# --- fixed values: start -----------------------------------------------------

# Message error classes, first match on the lower-cased text wins.
ERROR_CLASSES = [
    (r"timeout", "timeout"),
    (r"connection.*failed", "connection_failed"),
    (r"authentication.*failed", "authentication_failed"),
    (r"permission.*denied", "permission_denied"),
    (r"resource.*not.*found", "resource_not_found"),
    (r"invalid.*parameter", "invalid_parameter"),
    (r"rate.*limit", "rate_limit"),
    (r"memory.*error", "memory_error"),
    (r"disk.*full", "disk_full"),
    (r"network.*error", "network_error"),
]
ERROR_CLASS_DEFAULT = "other_error"

SERVICE_KEYWORDS = {
    "kyc-service": ["identity", "verification", "document", "check"],
    "ml-inference": ["model", "prediction", "inference", "tensor"],
    "oauth-handler": ["token", "authorization", "scope", "client"],
    "data-export": ["export", "download", "csv", "json"],
    "ingestion-service": ["ingest", "stream", "batch", "queue"],
    "data-pipeline": ["pipeline", "etl", "transform", "load"],
    "reporting-api": ["report", "analytics", "dashboard", "metric"],
    "transaction-validator": ["transaction", "validate", "amount", "currency"],
    "db-pool": ["database", "connection", "query", "pool"],
    "payments-core": ["payment", "charge", "refund", "settlement"],
}

SEVERITY_CODES = {"INFO": 0, "WARNING": 1, "ERROR": 2, "CRITICAL": 3}

# Case-insensitive evidence patterns per root cause.
LABEL_EVIDENCE = {
    "RC-01": [
        r"401.*Unauthorized", r"bearer token missing", r"invalid API key",
        r"authentication.*failed", r"HMAC.*signature.*mismatch",
    ],
    "RC-02": [
        r"connection.*exhausted", r"wait.*time.*exceeded", r"failed.*acquire.*connection",
        r"database.*unreachable", r"slow query.*detected",
    ],
    "RC-03": [
        r"upstream.*provider.*returned", r"502.*Bad Gateway", r"503.*Service Unavailable",
        r"failing over", r"dependency.*failure",
    ],
    "RC-04": [
        r"rate limit.*hit", r"Retry-After", r"throttling.*applied",
        r"429.*Too Many Requests", r"quota.*exceeded",
    ],
    "RC-05": [
        r"constraint.*violation", r"validation.*error", r"null.*value.*required",
        r"format.*error", r"enum.*mismatch",
    ],
    "RC-06": [
        r"privilege.*escalation", r"insufficient.*role", r"scope.*mismatch",
        r"unauthorized.*access", r"security.*violation",
    ],
    "RC-07": [
        r"memory.*limit.*reached", r"disk.*capacity", r"file descriptor.*limit",
        r"evicting.*keys", r"dropping.*logs",
    ],
    "RC-08": [
        r"packet.*loss", r"network.*segment", r"connectivity.*issue",
        r"latency.*spike", r"timeout.*network",
    ],
}

# Case-sensitive evidence patterns that apply to every message.
GENERAL_EVIDENCE = [
    ("error_codes", r"\b\d{3}\b"),
    ("error_codes", r"ERROR\s+\d+"),
    ("services", r"\[([^\]]+)\]"),
    ("metrics", r"\b\d+(?:\.\d+)?%"),
    ("metrics", r"\b\d+(?:\.\d+)?(?:ms|s|m|h)\b"),
    ("metrics", r"\b\d+(?:\.\d+)?(?:MB|GB|TB)\b"),
    ("entities", r"client_\w+"),
    ("entities", r"user_\w+"),
    ("entities", r"usr_\w+"),
    ("entities", r"\bIP:\s*\d+\.\d+\.\d+\.\d+\b"),
]

# Incident title, sentence, severity and expected time to resolution.
INCIDENTS = {
    "RC-01": ("Authentication/Authorization Failure",
              "Authentication or authorization failure detected. {evidence}",
              "High", "15-30 minutes"),
    "RC-02": ("Database Connection Pool Exhaustion",
              "Database connection pool exhausted or connection timeout. {evidence}",
              "Critical", "30-60 minutes"),
    "RC-03": ("Upstream Service Failure",
              "Upstream service dependency failure. {evidence}",
              "High", "30-60 minutes"),
    "RC-04": ("Rate Limiting/Throttling",
              "Rate limit exceeded or throttling applied. {evidence}",
              "Medium", "15-30 minutes"),
    "RC-05": ("Data Validation/Constraint Violation",
              "Data validation error or constraint violation. {evidence}",
              "Medium", "30-60 minutes"),
    "RC-06": ("Security/Authorization Policy Violation",
              "Security policy violation or unauthorized access attempt. {evidence}",
              "Critical", "Immediate investigation required"),
    "RC-07": ("Resource Exhaustion (Memory/Disk)",
              "System resource exhaustion detected. {evidence}",
              "Critical", "30-60 minutes"),
    "RC-08": ("Network/Infrastructure Issue",
              "Network or infrastructure problem detected. {evidence}",
              "Critical", "60+ minutes"),
}
INCIDENT_DEFAULT = ("Root Cause {label}", "Root cause identified: {evidence}",
                    "Medium", "Investigation required")

# Category name, phrases that count towards the category score, error types.
CATEGORIES = {
    "RC-01": ("Authentication/Authorization Failure",
              ["401", "Unauthorized", "bearer token", "API key", "authentication failed",
               "HMAC signature", "scope mismatch", "insufficient permissions"],
              ["AuthError", "PermissionError", "TokenError"]),
    "RC-02": ("Database Connection Pool Exhaustion",
              ["connection exhausted", "wait time exceeded", "failed to acquire connection",
               "database unreachable", "slow query", "DB connection", "connection pool"],
              ["ConnectionError", "TimeoutError", "PoolExhaustionError"]),
    "RC-03": ("Upstream Service Failure",
              ["upstream provider", "502 Bad Gateway", "503 Service Unavailable",
               "failing over", "dependency failure", "partner API", "external service"],
              ["DependencyError", "ServiceUnavailableError", "GatewayError"]),
    "RC-04": ("Rate Limiting or Throttling",
              ["rate limit", "burst limit", "429 Too Many Requests", "Retry-After",
               "throttling", "RPS exceeded", "quota exceeded"],
              ["RateLimitError", "ThrottlingError", "QuotaError"]),
    "RC-05": ("Data Validation or Schema Mismatch",
              ["validation error", "schema validation", "constraint violation", "null value",
               "format error", "type mismatch", "required field"],
              ["ValidationError", "SchemaError", "ConstraintError"]),
    "RC-06": ("Security Policy Violation",
              ["privilege escalation", "security policy", "access violation",
               "insufficient role", "blocked attempt", "unauthorized access"],
              ["SecurityError", "PolicyViolationError", "AccessError"]),
    "RC-07": ("Resource Exhaustion",
              ["memory limit", "disk full", "file descriptor", "OOM error",
               "resource exhausted", "capacity reached", "heap exhausted"],
              ["ResourceError", "OOMError", "CapacityError"]),
    "RC-08": ("Network Connectivity Issues",
              ["packet loss", "connection timeout", "TLS handshake", "network segment",
               "DNS resolution", "unreachable", "timeout after"],
              ["NetworkError", "TimeoutError", "ConnectivityError"]),
}

# Case-insensitive patterns behind each mined error type.
MINED_ERROR_TYPES = {
    "AuthError": [r"401.*Unauthorized", r"bearer token.*missing", r"invalid.*API.*key",
                  r"authentication.*failed", r"HMAC.*signature.*mismatch"],
    "PermissionError": [r"insufficient.*permissions?", r"access.*denied",
                        r"scope.*mismatch", r"privilege.*escalation"],
    "ConnectionError": [r"connection.*exhausted", r"failed.*acquire.*connection",
                        r"database.*unreachable", r"connection.*timeout"],
    "TimeoutError": [r"wait.*time.*exceeded", r"timeout.*after", r"slow.*query",
                     r"handshake.*timeout"],
    "DependencyError": [r"upstream.*provider", r"dependency.*failure",
                        r"external.*service", r"partner.*API"],
    "RateLimitError": [r"rate.*limit", r"burst.*limit", r"429.*Too Many Requests",
                       r"RPS.*exceeded"],
    "ValidationError": [r"validation.*error", r"schema.*validation",
                        r"constraint.*violation", r"format.*error"],
    "ResourceError": [r"memory.*limit", r"disk.*full", r"file.*descriptor",
                      r"resource.*exhausted"],
    "NetworkError": [r"packet.*loss", r"network.*segment", r"DNS.*resolution",
                     r"TLS.*handshake"],
}

MESSAGE_SHAPES = [
    (r"ERROR.*\[.*\].*", "Error with service context"),
    (r"WARN.*\[.*\].*", "Warning with service context"),
    (r"CRITICAL.*\[.*\].*", "Critical error with service context"),
    (r".*returned.*\d{3}.*", "HTTP status code returned"),
    (r".*timeout.*\d+.*ms.*", "Timeout with duration"),
    (r".*limit.*reached.*", "Limit reached pattern"),
    (r".*failed.*", "Failure pattern"),
    (r".*error.*", "Error pattern"),
    (r".*violation.*", "Violation pattern"),
    (r".*validation.*", "Validation pattern"),
]

# Compared as written with lower-cased text, so terms with capitals never match
# unless ``fold_terms`` is asked for.
TECHNICAL_TERMS = [
    "timeout", "limit", "failed", "error", "violation", "validation", "connection",
    "memory", "disk", "authentication", "authorization", "rate", "burst", "quota",
    "schema", "constraint", "privilege", "escalation", "network", "packet", "DNS",
    "TLS", "handshake", "upstream", "dependency", "provider", "service", "API",
    "database", "pool", "exhausted", "resource", "capacity", "OOM", "heap", "401",
    "unauthorized", "bearer token", "API key", "HMAC", "signature", "scope",
    "permissions", "502", "503", "bad gateway", "service unavailable", "429",
    "too many requests", "retry-after", "RPS", "throttling", "null", "format",
    "type mismatch", "required field", "security", "policy", "access violation",
    "blocked", "file descriptor", "full", "packet loss", "timeout after",
    "TLS handshake", "network segment",
]

# Thresholds.
SHAPE_MIN_SHARE = 0.3        # strictly more than
PHRASE_MIN_SHARE = 0.2       # at least, and at least one message
ERROR_TYPE_MIN_SHARE = 0.3   # at least
LOW_CONFIDENCE = 0.5
EVIDENCE_KEPT = 5
EVIDENCE_IN_SENTENCE = 3
EXCERPT_CHARS = 50

# --- fixed values: end -------------------------------------------------------
