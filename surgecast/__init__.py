"""Clinical demand forecasting from line lists, as PySpark DataFrame plans."""

from surgecast.config import ForecastDates, StudyConfig

__all__ = ["ForecastDates", "StudyConfig"]
