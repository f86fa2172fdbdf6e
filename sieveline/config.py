"""Policy constants; every operator takes them as parameters with these defaults."""

# Tags, thresholds and sizes that results depend on.

HEAD_RETRACTED, HEAD_RULE, HEAD_SCAN = 80, 120, 200
SNAPSHOT = {"retracted": "20260625", "junk_regex_v2": "junk_flags_v2(#79)", "junk_regex_v3": "junk_flags_v3.2(#131)"}
REASONS = ["retracted", "junk_regex_v2", "junk_regex_v3"]  # in order of priority
DOMINATED, REVIEW = 50.0, 30.0
SEED = 7
ABSTRACT_MIN_CHARS = 25
TAU, REF_MIN_DOCS, CORE_SHARE_MIN = 2.0, 3, 0.30
NEAR_DUPLICATE_THETA, SHINGLE_WORDS, SHINGLE_MIN_WORDS, SHINGLE_CHARS, SHINGLE_MIN_CHARS = 0.85, 5, 9, 8, 12
KEYWORD_MAX = 25
KEYWORD_MIN = {"junk": 0, "normal": 2, "mixed": 1}
AUDIT_PER_TYPE, AUDIT_TYPES_PER_BATCH = 40, 5
STRATIFIED_PER_TYPE, STRATIFIED_MIN = 45, 6
