from granero.functions import classify, dates, numbers, text  # noqa: F401
