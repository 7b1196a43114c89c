"""Set-based building blocks of the reports."""
