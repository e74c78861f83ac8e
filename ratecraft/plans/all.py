"""Import every query module so the registry is complete."""

from ratecraft.plans import q_models  # noqa: F401
from ratecraft.plans import q_profile  # noqa: F401
from ratecraft.plans import q_charts  # noqa: F401
from ratecraft.plans import q_split  # noqa: F401
from ratecraft.plans import q_io  # noqa: F401
from ratecraft.plans import q_ml  # noqa: F401
