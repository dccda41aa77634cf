"""Reading raw and clean tables, writing results. Every path is a parameter."""
