from . import dates, numbers, text  # noqa: F401
