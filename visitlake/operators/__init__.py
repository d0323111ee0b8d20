"""Row cleaning, admission, checks and the building blocks of the reports."""
