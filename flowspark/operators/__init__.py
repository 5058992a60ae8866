from .aws import *  # noqa: F403
from .azure import *  # noqa: F403
from .gcp import *  # noqa: F403
from .universal import universal_flow_log  # noqa: F401
