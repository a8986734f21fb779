from siltstone.functions.cleansing import SPEC_TYPES, cleansed
from siltstone.functions.names import qualified, quoted
from siltstone.functions.runs import elapsed_seconds

__all__ = ["SPEC_TYPES", "cleansed", "elapsed_seconds", "qualified", "quoted"]
