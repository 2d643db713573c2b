from . import adapter, io, schemas  # noqa: F401
