"""Layer builders: bronze parsing, silver dimensions and facts, gold frames, checks."""
