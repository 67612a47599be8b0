from tidemart.plans.graph import ModelGraph  # noqa: F401
