"""Status values."""

# Status of a table and of a run.
FAILED = "FAILED"
SUCCESS = "SUCCESS"
VALIDATION_FAILED = "VALIDATION_FAILED"
ERROR = "ERROR"
CONNECTION_ERROR = "CONNECTION_ERROR"
WORKER_ERROR = "WORKER_ERROR"
CRASHED = "CRASHED"
FAILURE = "FAILURE"
CRITICAL_FAILURE = "CRITICAL_FAILURE"

# Messages.
PIPELINE_LEVEL = "Pipeline Level"
VALIDATION_MESSAGE = "Count or type validation failed"
