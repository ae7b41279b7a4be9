"""Stage plans composed from operators, and the runner that reads and writes the layers."""
