"""Fixed values.

These numbers and strings must equal the evaluated pipeline's for results to
agree: rule weights, gate thresholds, prices, phrases, limits.  They are
parameters of the operators; this module only supplies the defaults.
"""

# --- fixed values: rule evaluator -------------------------------------------
CTA_PHRASE = "anything else"          # call-to-action phrase searched anywhere
VIOLATION_PENALTY = 0.25              # per forbidden substring present
CTA_BONUS = 0.1                       # when the phrase is present
PASS_SCORE = 0.6                      # passed = score >= 0.6 and no violation
RULE_SCORE_DECIMALS = 3               # stored case score rounding
COST_DECIMALS = 6                     # stored case cost rounding
JUDGE_AVG_DECIMALS = 2                # judge average rounding
JUDGE_DIMENSIONS = ("helpfulness", "faithfulness", "conciseness", "safety")
JUDGE_SCALE = 5.0                     # judge dims are 1..5

# --- fixed values: gates and prices ---------------------------------------------
GATE_RULE_PASS_RATE = 0.80            # >=
GATE_AVG_LATENCY_MS = 8000.0          # <=
GATE_AVG_COST_USD = 0.05              # <=
CC_MIN_IMPROVEMENT = 0.02             # challenger delta must be strictly greater
SCORE_THRESHOLD = 0.60                # composite needed to register
PER_1K_INPUT_USD = 0.0025
PER_1K_OUTPUT_USD = 0.0100

# --- fixed values: template defaults -------------------------------------------
TEMPLATE_TEMPERATURE = 0.3
TEMPLATE_MAX_TOKENS = 1024
TEMPLATE_VERSION = "1.0.0"
PROBE_MAX_LATENCY_MS = 8000.0

# --- fixed values: misc --------------------------------------------------------
TOKENS_PER_WORD = 1.3                 # approximate token count = int(words * 1.3)
CONFIG_HASH_CHARS = 12                # sha-256 hex prefix of the canonical config
RUN_SHA_CHARS = 8                     # git sha prefix in run names
SNIPPET_CHARS = 120                   # reply snippet in smoke results
PREVIEW_CHARS = 60                    # user message preview
REPLY_PREVIEW_CHARS = 80              # reply preview (newlines -> spaces)
MIN_SKILLS = 5                        # skills scorer passes when len > 5
AGENT_MAX_ITER = 10                   # tool-calling loop limit
RETRY_ATTEMPTS = 3                    # chat call attempts on timeout
RETRY_TIMEOUT_S = 20.0
RETRY_BACKOFF_BASE_S = 2.0            # wait 2 * 2**attempt seconds
TERMINAL_EVENT = "response.output_item.done"
APPROVED_VALUE = "approved"
STAGING_TAG = "cd_staging"
STAGING_PASS = "pass"
PSI_ALERT = 0.2                       # drift alert level
PSI_FLOOR = 1e-6
TRAFFIC_SHARE_PCT = 10                # shadow / challenger traffic share

# Whitespace as Python's str.split() sees it.
WORD_SEPARATORS = r"[\s\x1c-\x1f\x85\p{Z}]+"
WORD_TOKEN = r"[^\s\x1c-\x1f\x85\p{Z}]+"
