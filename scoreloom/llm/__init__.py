"""Operations of a training-data pipeline. Nothing else in the library imports this package."""

from scoreloom.session import ship_with_tasks

ship_with_tasks(__name__)
