"""Column expressions (the X-rows of the survey). No Python UDFs."""

from sensorlake.functions.text import *  # noqa: F401,F403
from sensorlake.functions.time import *  # noqa: F401,F403
from sensorlake.functions.quality import *  # noqa: F401,F403
