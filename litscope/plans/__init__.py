"""User-facing searches and trend reports, and the registered queries."""
