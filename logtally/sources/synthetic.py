"""Sample logs of any size, the same for the same seed.

Every record draws its random numbers from one SHA-256 digest of seed, file and record number, so
a task that runs again, or a different partitioning, yields the same lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What records are made of. A level listed twice is twice as likely.
LEVELS = ("DEBUG", "INFO", "INFO", "INFO", "WARN", "WARN", "ERROR", "ERROR", "FATAL")
THREADS = (
    "main",
    "http-nio-8080-exec-1",
    "http-nio-8080-exec-2",
    "scheduler-1",
    "kafka-consumer-1",
    "db-pool-3",
    "async-executor-4",
    "worker-thread-7",
)
LOGGERS = (
    "com.example.UserService",
    "com.example.OrderController",
    "com.example.PaymentGateway",
    "com.example.DatabasePool",
    "com.example.CacheManager",
    "org.hibernate.SQL",
    "org.springframework.web.servlet.DispatcherServlet",
    "com.example.KafkaConsumer",
    "com.example.AuthFilter",
)
# Messages per level; {} stands for a number from 1000 to 9999.
MESSAGES = {
    "DEBUG": ("Entering method processRequest with params=[{}, 'active']",),
    "INFO": (
        "User login successful for userId={}",
        "Processing order orderId={} for customerId={}",
        "Cache hit for key=session:{}",
        "Scheduled job '{}' started",
        "HTTP GET /api/v1/products returned 200 in {}ms",
        "Database connection acquired from pool (active={}/{})",
        "Kafka message consumed from topic '{}' partition={}",
        "JWT token validated for subject={}",
        "Email notification sent to user {}",
        "Payment processed successfully txnId={}",
    ),
    "WARN": (
        "Slow query detected ({}ms): SELECT * FROM orders WHERE customer_id={}",
        "Cache eviction triggered, size exceeded threshold ({})",
        "Retry attempt {}/3 for remote service call",
        "Connection pool near capacity ({}/{}), consider increasing pool size",
        "Deprecated API endpoint /api/v1/legacy called by {}",
        "High memory usage detected: {}% of heap used",
        "Rate limit approaching for clientId={}",
    ),
    "ERROR": (
        "NullPointerException in UserService.getUserById at line 142",
        "Connection refused to database host db-primary:5432",
        "SQLException: deadlock detected on table 'orders'",
        "OutOfMemoryError: Java heap space",
        "TimeoutException: Remote call to payment-service timed out after 5000ms",
        "Connection reset by peer: socket write error",
        "IllegalArgumentException: Invalid parameter 'userId'=null",
        "Failed to deserialize Kafka message: com.fasterxml.jackson.core.JsonParseException",
        "HTTP 500 Internal Server Error for POST /api/v1/checkout",
        "Authentication failed: invalid credentials for user={}",
    ),
    "FATAL": (
        "Critical database connection pool exhausted — application cannot serve requests",
        "Unrecoverable error: file system full at /var/log/app",
        "JVM crash detected: SIGSEGV in native thread",
    ),
}
# The first file starts at this time, each further one this many hours later.
START, FILE_HOURS = "2024-06-01 08:00:00", 8
# Lines that follow every so many errors.
TRACE_SHARE, CAUSE_SHARE = 30, 50  # percent
AT_SERVICE = "\tat com.example.Service.method(Service.java:"
AT_CONTROLLER = "\tat com.example.Controller.handle(Controller.java:"
CAUSE = "\tCaused by: java.lang.RuntimeException: underlying cause"

# Records per step of the running clock sum.
BLOCK = 100_000
_HEX_PER_DRAW = 5


def _draw(number: int, below: int) -> Column:
    """The ``number``-th random integer of the record, from 0 to ``below`` - 1."""
    digits = F.substring("digest", 1 + _HEX_PER_DRAW * number, _HEX_PER_DRAW)
    return F.conv(digits, 16, 10).cast("int") % below


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), index + 1)


def write_records(records: DataFrame, seed: int = 0) -> DataFrame:
    """Log lines for a DataFrame of ``file`` (from 1) and ``record`` (from 0 in every file).

    Gives ``source_file``, ``record``, ``part`` (0 for the record itself, then its stack trace)
    and ``raw``. The clock of a file moves on by 1 to 500 ms per record. It is summed up in two
    steps, within blocks of records and over the blocks, so that no file is one task's work.
    """
    key = F.concat_ws("|", F.lit(seed), "file", "record")
    drawn = records.select("file", "record", F.sha2(key, 256).alias("digest"))
    drawn = drawn.withColumns(
        {
            "block": F.floor(F.col("record") / BLOCK),
            "level": _pick(LEVELS, _draw(0, len(LEVELS))),
            "step": _draw(1, 500) + 1,
        }
    )
    totals = drawn.groupBy("file", "block").agg(F.sum("step").alias("steps"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("file", "block", F.coalesce(F.sum("steps").over(earlier), F.lit(0)).alias("before"))
    so_far = Window.partitionBy("file", "block").orderBy("record").rowsBetween(Window.unboundedPreceding, 0)
    clock = drawn.withColumn("within", F.sum("step").over(so_far)).join(totals, ["file", "block"])

    elapsed = F.make_dt_interval(
        hours=(F.col("file").cast("int") - 1) * FILE_HOURS,
        secs=((F.col("before") + F.col("within")) / 1000).cast("decimal(18,6)"),
    )
    time = F.lit(START).cast("timestamp_ntz") + elapsed
    # The printed milliseconds are a draw of their own.
    printed = F.concat(F.substring(time.cast("string"), 1, 19), F.lit("."), F.lpad(_draw(2, 1000).cast("string"), 3, "0"))
    number = (_draw(3, 9000) + 1000).cast("string")
    level, message = F.col("level"), F.lit(None).cast("string")
    for name, templates in MESSAGES.items():
        message = F.when(level == name, _pick(templates, _draw(4, len(templates)))).otherwise(message)
    line = F.concat(
        printed, F.lit(" "), F.rpad(level, 5, " "),
        F.lit(" ["), _pick(THREADS, _draw(5, len(THREADS))), F.lit("] "), _pick(LOGGERS, _draw(6, len(LOGGERS))),
        F.lit(" - "), F.replace(message, F.lit("{}"), number),
    )
    traced = level.isin("ERROR", "FATAL") & (_draw(7, 100) < TRACE_SHARE)
    parts = F.array_compact(
        F.array(
            line,
            F.when(traced, F.concat(F.lit(AT_SERVICE), (_draw(8, 491) + 10).cast("string"), F.lit(")"))),
            F.when(traced, F.concat(F.lit(AT_CONTROLLER), (_draw(9, 291) + 10).cast("string"), F.lit(")"))),
            F.when(traced & (_draw(10, 100) < CAUSE_SHARE), F.lit(CAUSE)),
        )
    )
    source_file = F.concat(F.lit("app_"), F.col("file").cast("string"), F.lit(".log")).alias("source_file")
    return clock.select(source_file, "record", F.posexplode(parts).alias("part", "raw"))


def generate_logs(spark: SparkSession, lines: int = 50_000, files: int = 3, seed: int = 0) -> DataFrame:
    """``lines`` records, and the stack traces among them, in each of ``files`` files."""
    ids = spark.range(lines * files)
    file = F.floor(F.col("id") / lines) + 1
    return write_records(ids.select(file.alias("file"), (F.col("id") % lines).alias("record")), seed)
