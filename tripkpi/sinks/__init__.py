"""tripkpi.sinks"""
