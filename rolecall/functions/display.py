"""Texts that serving clients show."""

from pyspark.sql import Column, functions as F

# Salary texts that show no amount, and what is shown instead.
UNSHOWN_SALARIES = ("Login to view", "Negotiable", "Hidden", "")
SALARY_PLACEHOLDER = "🔒 You'll love it"


def salary_display(salary: Column) -> Column:
    return (
        F.when(salary.isNull() | salary.isin(*UNSHOWN_SALARIES), SALARY_PLACEHOLDER)
        .otherwise(salary)
    )


def _money(amount: Column) -> Column:
    return F.format_number(F.coalesce(amount, F.lit(0.0)), 0)


def salary_range_display(low: Column, high: Column, currency: Column) -> Column:
    """``1,000 - 2,000 USD``, or ``Từ 1,000 USD`` without a distinct upper end."""
    top = F.coalesce(high, F.lit(0.0))
    ranged = (top > 0) & (top != F.coalesce(low, F.lit(0.0)))
    code = F.coalesce(currency, F.lit("VND"))
    return (
        F.when(ranged, F.concat(_money(low), F.lit(" - "), _money(high), F.lit(" "), code))
        .otherwise(F.concat(F.lit("Từ "), _money(low), F.lit(" "), code))
    )


def location_report_line(location: Column, currency: Column, total: Column, low: Column, high: Column) -> Column:
    """Three-line summary of one market row; missing averages show as 0."""
    icon = (
        F.when(location.contains("Ho Chi Minh"), "🏙️")
        .when(location.contains("Ha Noi"), "🏯")
        .otherwise("📍")
    )
    return F.concat(
        icon, F.lit(" **"), location, F.lit("** ("), currency, F.lit(")\n • Số job tuyển: **"),
        total.cast("string"), F.lit("**\n • Lương TB (Min): **"), _money(low),
        F.lit("**\n • Lương TB (Max): **"), _money(high), F.lit("**\n"),
    )
