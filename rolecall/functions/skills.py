"""Skill detection over search text."""

import re

from pyspark.sql import Column, functions as F

# The skill dictionary, in its natural order.
SKILLS = (
    "python", "sql", "spark", "airflow", "docker", "kafka", "aws", "azure",
    "gcp", "java", "javascript", "typescript", "react", "node", "php",
    "c#", ".net", "golang", "go", "devops", "linux", "power bi", "tableau",
    "machine learning", "data engineer", "data analyst", "etl", "dbt",
)


def matched_skills(text: Column, skills=SKILLS, whole_words: bool = False) -> Column:
    """Array of the labels of all skills found in a search text.

    By default a skill matches as a substring ("go" is found in "golang").
    ``whole_words=True`` asks for non-word characters on both sides. Labels are
    literals: ``initcap('.net')`` would not give ``.Net``.
    """
    def found(skill: str) -> Column:
        if whole_words:
            # the plain search spares most texts the pattern
            return text.contains(skill) & text.rlike(rf"(^|[^a-z0-9+#.]){re.escape(skill)}($|[^a-z0-9+#])")
        return text.contains(skill)

    return F.array_compact(F.array(*[F.when(found(s), F.lit(s.title())) for s in skills]))
