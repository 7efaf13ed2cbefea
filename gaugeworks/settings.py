"""Fixed values of the data model: rule seeds, name lists and thresholds. Every user of one takes it as an
argument; these are the defaults, in one place."""

# (class_id, priority, program pattern, category, note)
SEED_RULES = [
    (1, 10, "%Integration Services%", "ETL/SSIS", None),
    (2, 11, "SSIS-%", "ETL/SSIS", None),
    (3, 20, "%Tableau%", "BI/Tableau", None),
    (4, 21, "%Power BI%", "BI/Power BI", None),
    (5, 22, "%MSOLAP%", "BI/Analysis Services", None),
    (6, 30, "%Report Server%", "Reporting/SSRS", None),
    (7, 31, "%ReportingServices%", "Reporting/SSRS", None),
    (8, 40, "%Azure Data Factory%", "ETL/ADF", None),
    (9, 41, "%azure-sql-%", "ETL/ADF", None),
    (10, 50, "%Management Studio%", "Admin/SSMS", None),
    (11, 51, "SQLCMD%", "Admin/CLI", None),
    (12, 52, "%azdata%", "Admin/CLI", None),
    (13, 60, "%.Net SqlClient%", "App (generic)", None),
    (14, 61, "%ODBC%", "App/Extract (ODBC)", None),
    (15, 62, "%jdbc%", "App/Extract (JDBC)", None),
    (99, 999, "%", "Unknown", None),
]

UNKNOWN_CATEGORY = "Unknown"

# Wait categories, first hit wins: (category, LIKE pattern or None, exact names)
WAIT_CATEGORIES = [
    ("Lock", r"LCK\_M%", []),
    ("Parallelism", None, ["CXPACKET", "CXCONSUMER"]),
    ("IO", "PAGEIOLATCH%", ["IO_COMPLETION", "ASYNC_IO_COMPLETION", "WRITELOG", "BACKUPIO"]),
    ("Memory", None, ["RESOURCE_SEMAPHORE", "CMEMTHREAD", "RESOURCE_SEMAPHORE_QUERY_COMPILE"]),
    ("Network", None, ["ASYNC_NETWORK_IO", "NET_WAITFOR_PACKET"]),
    ("CPU", None, ["SOS_SCHEDULER_YIELD", "THREADPOOL"]),
]
OTHER_WAIT_CATEGORY = "Other"

# Idle waits that carry no signal.
WAIT_EXCLUSIONS = [
    "SLEEP_TASK",
    "LAZYWRITER_SLEEP",
    "WAITFOR",
    "BROKER_TASK_STOP",
    "BROKER_TO_FLUSH",
    "XE_TIMER_EVENT",
    "XE_DISPATCHER_WAIT",
    "REQUEST_FOR_DEADLOCK_SEARCH",
    "SQLTRACE_INCREMENTAL_FLUSH_SLEEP",
    "DIRTY_PAGE_POLL",
    "HADR_FILESTREAM_IOMGR_IOCOMPLETION",
    "CHECKPOINT_QUEUE",
    "FT_IFTS_SCHEDULER_IDLE_WAIT",
]

FULL_BACKUP_MAX_AGE_HOURS = 24
LOG_BACKUP_MAX_AGE_HOURS = 4

GROWTH_LOOKBACK_DAYS = 30
TREND_DAYS = 90
TUNING_MIN_KB = 10_240
TUNING_LARGE_KB = 1_048_576
TOP_QUERIES = 50
RECENT_RUNS = 50
PAGE_KB = 8
FIRST_USER_SESSION = 51
LAST_SYSTEM_DATABASE_ID = 4
SCHEDULER_ID_LIMIT = 255
EVENT_MIN_DURATION_MS = 1000

# How far behind its mark an incremental run reads again, in seconds: events reach the log up to half a minute after their time.
EVENT_OVERLAP_SECONDS = 300
