from .days import ENTITY_VIEWS, EntityDays
from .rolling import RollingBaseline
from .views import VIEWS, FlowViews

__all__ = ["ENTITY_VIEWS", "VIEWS", "EntityDays", "FlowViews", "RollingBaseline"]
