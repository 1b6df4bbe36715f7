"""Column functions: every one takes columns and returns a column."""

from tierloom.functions.strings import *  # noqa: F401,F403
from tierloom.functions.times import *  # noqa: F401,F403
from tierloom.functions.values import *  # noqa: F401,F403
