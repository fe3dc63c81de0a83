"""Jobs composed from the operators: cleaning, collecting, checking, forecasting."""
