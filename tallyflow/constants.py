"""Fixed values.

These must equal the reference's values for matching keys, codes and
rounding. They are stated here once, plainly, and imported everywhere else.
"""

# --- fixed values: key prefixes of the three published metrics -------------
TAOBAO_PREFIX = "platformTaobao_"
TMALL_PREFIX = "platformTmall_"
RATIO_PREFIX = "ratio_"

# --- fixed values: coded domains ------------------------------------------
PLATFORM_TAOBAO = 0  # order type 0 is Taobao, anything else Tmall
PLATFORM_TMALL = 1
PLATFORM_NAMES = {0: "taobao", 1: "tmall"}

DEVICE_PC = 0  # pay platform 0 is PC, anything else wireless
DEVICE_WIRELESS = 1
DEVICE_LABELS = {0: "pc", 1: "wireless"}

PAY_SOURCE_LABELS = {0: "alipay", 1: "voucher", 2: "unionpay", 3: "other"}

# --- fixed values: arithmetic ------------------------------------------------
CENTS_PER_UNIT = 100
MILLIS_PER_MINUTE = 60_000
SECONDS_PER_MINUTE = 60
DEFAULT_DIV_SCALE = 10  # scale of the exact division helper
JAVA_DOUBLE_MAX = 1.7976931348623157e308  # ratio when only wireless paid

# --- fixed values: fingerprint shifts (collides by design) -------------------
FINGERPRINT_SOURCE_SHIFT = 10
FINGERPRINT_PLATFORM_SHIFT = 11

# --- fixed values: streaming ------------------------------------------------
LATE_MINUTES = 5  # a newer minute rewrites current-5 .. current
EXPECTED_MINUTES = 181  # completion test of the contest data set
END_MARKER = bytes([0, 0])  # two-byte end-of-feed message body
RECORD_SEPARATOR = ";;\n"  # delimited order file record separator

# Default team code for metric keys; a deployment passes its own.
DEFAULT_TEAM = "team"
