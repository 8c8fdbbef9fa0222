"""The lake's jobs, built from the operators: landing, processed and warehouse tables."""
