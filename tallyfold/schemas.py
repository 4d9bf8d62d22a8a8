"""Fixed values of the file formats."""

# Names, levels and extensions the file formats prescribe.
SALES_HEADER = "fecha,producto,categoria,precio_unitario,cantidad,descuento"
SUPPORTED_EXTENSIONS = (".csv", ".json", ".log")
CRITICAL_LEVELS = ("FATAL", "ERROR")
LOG_PATTERN = (
    r"(?d)^(\d{4}-\d{2}-\d{2})\s+(\d{2}:\d{2}:\d{2})\s+"
    r"\[([A-Z]+)\]\s+\[([^\]]+)\]\s+(.*)$"
)

# Row and file error texts.
ERR_EMPTY_CSV = "Empty CSV"
ERR_HEADER = "Invalid CSV header"
ERR_COLUMNS = "Row must have 6 columns"
ERR_DATE = "Invalid date format (expected YYYY-MM-DD)"
ERR_PRICE = "Invalid unit price"
ERR_QUANTITY = "Invalid quantity"
ERR_DISCOUNT = "Invalid discount"
ERR_PRICE_SIGN = "Unit price must be positive"
ERR_QUANTITY_SIGN = "Quantity must be positive"
ERR_DISCOUNT_RANGE = "Discount must be between 0 and 100"
ERR_QUOTE = "CSV parse error: unexpected quote character"
ERR_LOG_FORMAT = "Invalid log format"
ERR_TIMESTAMP = "Invalid timestamp"
ERR_JSON = "JSON decode error: malformed document"
ERR_JSON_ROOT = "JSON root must be an object"
ERR_UNREADABLE = "read_failed"

# Discovery and run error reasons with their texts.
DETAILS = {
    "directory_not_found": "The given path is not a directory or does not exist.",
    "file_not_found": "The given path is not a file or does not exist.",
    "no_supported_files": "Directory contains no supported files.",
    "unsupported_format": "The {ext} extension is not supported.",
    "no_successful_files": (
        "All files have errors or didn't reach status :ok (total={total}, ok={ok}). "
        "Please check the logs for more details."
    ),
    "invalid_mode": 'Unsupported mode: {mode}. Try allowed modes: "parallel", "sequential".',
    "argument_malformed": (
        "The given arguments are incorrect, the arguments must be: 1. a directory/file string path, "
        "2. an output file string path, 3. a mode string indicator (parallel or sequential), and "
        "4. a list of options (:max_workers, :timeout_ms and :retries)"
    ),
}
