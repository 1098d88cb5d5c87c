"""Fixed values that results depend on.

FIXED VALUES: these regular expressions, formats and constants define what the
log operators extract, so they must stay exactly as written for results to
match the analyses they re-create. They are Java regex syntax (Spark's
``regexp_extract``); the DuckDB oracle uses the same text.
"""

# --- fixed values: log record patterns ---------------------------------------
# level, first word-bounded match anywhere in the line
LEVEL_WORD = r"\b(INFO|WARN|ERROR|DEBUG)\b"
# level, first match without word boundaries (documented recipe variant)
LEVEL_LOOSE = r"(INFO|WARN|ERROR|DEBUG)"
# component / logger name: text after the level up to the first colon (group 2)
COMPONENT = r"(INFO|WARN|ERROR|DEBUG)\s+([^:]+):"
# timestamp text at the start of the line
TIMESTAMP = r"^(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"

# --- fixed values: path patterns ---------------------------------------------
# cluster id (group 1) and zero-padded app number (group 2) from the folder
APP_DIR = r"application_(\d+)_(\d+)/"
# whole application id, keeps the "application_" prefix (group 0)
APPLICATION_ID = r"application_(\d+_\d+)"
# container id from the file name (group 1)
CONTAINER_ID = r"(container_\d+_\d+_\d+_\d+)"
# container parts: cluster, app, attempt, container number
CONTAINER_PARTS = r"container_(\d+)_(\d+)_(\d+)_(\d+)"
# container number of the ApplicationMaster; every other container is an executor
AM_CONTAINER = "000001"
# host names of the cluster nodes
HOST = r"(mesos-(?:slave|master)-\d+)"

# --- fixed values: message patterns ------------------------------------------
TASK_START = r"Running task (\S+) in stage (\S+) \(TID (\d+)\)"
TASK_FINISH = r"Finished task (\S+) in stage (\S+) \(TID (\d+)\)"
PYTHON_TIMES = r"Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)"
RESOURCE_REQUEST = r"Will request (\d+) executor containers, each with (\d+) cores and (\d+) MB memory"
CONTAINER_REQUEST = r"Container request \(host: ([^,]*), capability: <memory:(\d+), vCores:(\d+)>\)"
SHUFFLE_FETCH = r"Getting (\d+) non-empty blocks out of (\d+) blocks"
MEMORY_BLOCK = r"Block (\S+) stored as bytes in memory \(estimated size ([0-9.]+) (B|KB|MB|GB)"
INPUT_SPLIT = r"Input split: (.*):(\d+)\+(\d+)$"
# continuation lines of a multi-line entry are lines not starting with a timestamp
ENTRY_BREAK = r"\n(?=\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"

# --- fixed values: units and summary text ------------------------------------
UNIT_BYTES = {"B": 1, "KB": 1024, "MB": 1024 ** 2, "GB": 1024 ** 3}
LEVELS = ("INFO", "WARN", "ERROR", "DEBUG")
# summary report: header labels (followed by the figure) and the per-level
# line (level left-aligned in 5, count with thousands separators right-aligned
# in 10 and never cut, share with two decimals in 6)
SUMMARY_LABELS = (
    "Total log lines processed: ",
    "Total lines with log levels: ",
    "Unique log levels found: ",
    "",
    "Log level distribution:",
)
SUMMARY_LEVEL_FORMAT = "  %-5s: %10s (%6.2f%%)"
# usage statistics report, in order (format_string patterns)
STATS_LINES = (
    "Total clusters: %d",
    "Total applications: %d",
    "Average applications per cluster: %.2f",
    "Average application duration (sec): %.2f",
    "Min application duration (sec): %d",
    "Max application duration (sec): %d",
    "",
    "Most heavily used clusters:",
)
STATS_TOP_LINE = "  Cluster %s: %d applications"
# histogram and density curve of application durations
HIST_BINS = 30
KDE_POINTS = 500
